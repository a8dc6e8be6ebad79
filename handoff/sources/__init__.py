"""Sources and sinks: tables, contracts, run events, file digests, manifests, fingerprints."""
