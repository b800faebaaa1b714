"""Review log as a stream: the verdict that holds after each batch of events."""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame

_OUT = "utterance_id string, seq long, decision string, transcript string, depth int"
_STATE = "decisions array<string>, transcripts array<string>, seqs array<long>"


def _fold(key: tuple, batches: Iterator[pd.DataFrame], state) -> Iterator[pd.DataFrame]:
    decisions, transcripts, seqs = (list(x) for x in state.get) if state.exists else ([], [], [])
    last = 0
    for event in pd.concat(list(batches)).sort_values("seq", kind="stable").to_dict("records"):
        last = int(event["seq"])
        if event["action"] == "set":
            decisions.append(event["decision"])
            transcripts.append(event["transcript"])
            seqs.append(last)
        elif seqs:
            for stack in (decisions, transcripts, seqs):
                stack.pop()
    state.update((decisions, transcripts, seqs))
    top = (decisions[-1], transcripts[-1]) if seqs else (None, None)
    yield pd.DataFrame({"utterance_id": [key[0]], "seq": [last], "decision": [top[0]], "transcript": [top[1]], "depth": [len(seqs)]})


def stream_verdicts(events: DataFrame) -> DataFrame:
    """A row for each key and batch that has events of it: the latest seq, the verdict that holds (null for none), the stack's depth.

    The stack of each key is state. Events of a batch are put in order of seq; a later batch is taken to be later in the log.
    """
    return events.select("utterance_id", "seq", "action", "decision", "transcript").groupBy("utterance_id").applyInPandasWithState(
        _fold, _OUT, _STATE, "update", "NoTimeout"
    )
