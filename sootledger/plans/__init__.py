"""The footprint jobs: enrichment, loading, questions, panels and quality."""
