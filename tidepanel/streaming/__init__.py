from tidepanel.streaming.landing import IngestResult, gate_violations, ingest_landed

__all__ = ["IngestResult", "gate_violations", "ingest_landed"]
