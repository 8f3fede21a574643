"""Sources and sinks: catalog documents, feed payloads, bindings of the provided tables, brief sink."""
