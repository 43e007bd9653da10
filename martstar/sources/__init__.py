"""Sources and sinks: landing JSON, vendor payloads, warehouse tables."""
