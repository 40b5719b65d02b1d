"""Table scans, artefact readers and sinks."""
