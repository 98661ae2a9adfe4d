"""Structured Streaming: message sources, windowed aggregation with
watermarks (append mode), the per-window gate inside ``foreachBatch`` and
idempotent keyed-table sinks."""
