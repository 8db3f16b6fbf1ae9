import datetime as dt
import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parent.parent))

from sootledger.session import local_session  # noqa: E402

SITE_OF = {"PARIS": "Paris", "LOSANGELES": "LA", "BERLIN": "Berlin"}


@pytest.fixture(scope="session")
def spark():
    session = local_session("tests", cores=8, partitions=4)
    yield session
    session.stop()


def rows(df, *columns):
    """Rows as a sorted list of tuples."""
    picked = df.select(*columns) if columns else df
    return sorted((tuple(r) for r in picked.collect()), key=lambda r: [(x is None, str(x)) for x in r])


class Drops:
    """Writes drop files the way sites deliver them."""

    trip_header = (
        "ID_MISSION;ID_PERSONNEL;NOM_PERSONNEL;PRENOM_PERSONNEL;DATE_MISSION;TYPE_MISSION;"
        "VILLE_DEPART;PAYS_DEPART;VILLE_DESTINATION;PAYS_DESTINATION;TRANSPORT;ALLER_RETOUR"
    )
    goods_header = "ID_MATERIELINFO;ID_PERSONNEL;NOM_PERSONNEL;PRENOM_PERSONNEL;DATE_ACHAT;TYPE;MODELE"
    people_header = "ID_PERSONNEL;FONCTION_PERSONNEL;DT_NAISS;TS_CREATION_PERSONNEL"

    def __init__(self, root: Path):
        self.root = root
        root.mkdir(parents=True, exist_ok=True)

    def _write(self, path: Path, header: str, lines):
        path.parent.mkdir(parents=True, exist_ok=True)
        path.write_text("\n".join([header, *lines]) + "\n", encoding="utf-8")

    def trips(self, site, day: dt.date, lines, header=None):
        path = self.root / f"DATA_{site}" / f"DATA_{site}_MISSION" / f"MISSION_{day:%Y%m%d}.txt"
        self._write(path, header or self.trip_header, lines)

    def goods(self, site, day: dt.date, lines, header=None):
        folder = self.root / f"DATA_{site}" / f"DATA_{site}_INFORMATIQUE"
        path = folder / f"MATERIEL_INFORMATIQUE_{day:%Y%m%d}.txt"
        self._write(path, header or self.goods_header, lines)

    def people(self, site, lines):
        path = self.root / f"DATA_{site}" / f"PERSONNEL_{site}.txt"
        self._write(path, self.people_header, lines)


@pytest.fixture
def drops(tmp_path):
    return Drops(tmp_path / "drops")


@pytest.fixture(scope="session")
def reference_files(tmp_path_factory):
    """The five reference files, with the edge rows the rules need."""
    root = tmp_path_factory.mktemp("references")
    (root / "impacts.csv").write_text(
        " Type ,Modèle,Impact\n"
        "PC portable,modèle par défaut,260\n"
        "PC portable,Modèle Par Défaut ,999\n"
        "PC fixe sans ecran,Modèle par défaut,300.5\n"
        "PC portable,ProBook,210\n"
        "Serveur,ProBook,9999\n"
        "Ecran,OMEN ,150\n"
        "Ecran,Sans impact,\n",
        encoding="utf-8",
    )
    (root / "distances.csv").write_text(
        "VILLE_DEPART;PAYS_DEPART;VILLE_DESTINATION;PAYS_DESTINATION;DISTANCE_KM\n"
        "Paris;France;London;England;1\n"
        " Paris ;France;London;England;344.2\n"
        "Paris;France;Osaka;Japan;inconnue\n",
        encoding="utf-8",
    )
    (root / "transports.tsv").write_text(
        "name\tsubcategory\tsubsubcategory\ttotal\n"
        "a\tPlane\tShort haul (<1000 km)\t0.2586\n"
        "b\tPlane\tShort haul second row\t9\n"
        "c\tPlane\tMedium haul\t0.1875\n"
        "d\tPlane\tLong haul\t0.1520\n"
        "e\tRail\tTrain < 200 km\t0.0183\n"
        "f\tRail\tTGV > 200 km\t0.0024\n"
        "g\tBus\tCity bus\t0.1\n"
        "h\tBus\t\t0.2\n",
        encoding="utf-8",
    )
    (root / "cars.tsv").write_text(
        "name\tsubcategory\ttotal\na\tCar\t0.2\nb\tCar\t0.3\nc\tVan\t7\n", encoding="utf-8"
    )
    (root / "coordinates.csv").write_text(
        "ville;pays;lat;lon\n"
        "Paris;France;48.8566;2.3522\n"
        "London;England;51.5074;-0.1278\n"
        "Osaka;Japan;34.6937;135.5023\n"
        "Paris;USA;33.6609;-95.5555\n"
        "Los Angeles;USA;34.0522;-118.2437\n",
        encoding="utf-8",
    )
    names = {"impacts": "impacts.csv", "distances": "distances.csv",
             "transports": "transports.tsv", "cars": "cars.tsv", "coordinates": "coordinates.csv"}
    return {k: str(root / v) for k, v in names.items()}
