from tarnlake.streaming.ingest import CORRUPT_COLUMN, stream_json, stream_table
from tarnlake.streaming.ledger import Ledger, append_once
from tarnlake.streaming.salvage import dead_letters, replay_as_csv
from tarnlake.streaming.segments import compact, merged_segments, update_stream
from tarnlake.streaming.sinks import append_stream, complete_stream

__all__ = [
    "CORRUPT_COLUMN",
    "Ledger",
    "append_once",
    "append_stream",
    "compact",
    "complete_stream",
    "dead_letters",
    "merged_segments",
    "replay_as_csv",
    "stream_json",
    "stream_table",
    "update_stream",
]
