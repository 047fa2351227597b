"""Hooks for external services: text recognition, models, embeddings.

A provider is a function of one input that may raise. Calls run in partitions, each with
its retries; ``parallel`` caps how many run at once. Results come back as text, or as a list of
floats, and errors as rows, so a failed call never fails the job.
"""

from __future__ import annotations

import time
from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import DataFrame

RETRIES, PARALLEL = 2, 3


def call_provider(df: DataFrame, key: str, value: str, provider: Callable[..., str], retries: int = RETRIES,
                  parallel: int = PARALLEL, accept: Callable[[str], None] | None = None, numbered: bool = False) -> DataFrame:
    """(key, answer, error, attempts) for every row of ``df``. An answer that ``accept`` raises on (it does
    not parse, say) is a failed attempt like a call that raises. With ``numbered`` the provider is
    also told which attempt it is, from 0."""
    kind = df.schema[key].dataType.simpleString()

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for f in frames:
            out = []
            for k, v in zip(f[key], f[value], strict=True):
                answer = error = None
                attempts = 0
                while answer is None and attempts <= retries:
                    attempts += 1
                    try:
                        got = provider(v, attempts - 1) if numbered else provider(v)
                        if accept:
                            accept(got)
                        answer, error = got, None
                    except Exception as e:  # noqa: BLE001  the provider's errors are data
                        error = f"{type(e).__name__}: {e}"
                out.append((k, answer, error, attempts))
            yield pd.DataFrame(out, columns=[key, "answer", "error", "attempts"])

    return df.select(key, value).repartition(parallel).mapInPandas(run, f"`{key}` {kind}, answer string, error string, attempts int")


def recognised(df: DataFrame, key: str, provider: Callable[[str], list[dict]], retries: int = RETRIES, parallel: int = PARALLEL) -> DataFrame:
    """(key, page, text, error) of documents handed to text recognition, one row per piece of text; a document
    without any text, or whose calls fail, gives one row with the error. Pieces are {page, text}."""
    kind = df.schema[key].dataType.simpleString()

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for f in frames:
            for k in f[key]:
                pieces, error = None, None
                for _ in range(retries + 1):
                    try:
                        pieces, error = provider(k), None
                        break
                    except Exception as e:  # noqa: BLE001  the provider's errors are data
                        error = f"{type(e).__name__}: {e}"
                if not pieces and error is None:
                    error = "no text found"
                rows = [(k, int(p.get("page") or 1), p["text"], None) for p in pieces or ()] or [(k, None, None, error)]
                yield pd.DataFrame(rows, columns=[key, "page", "text", "error"]).astype({"page": "Int32"})

    return df.select(key).repartition(parallel).mapInPandas(run, f"`{key}` {kind}, page int, text string, error string")


#: Polls of a job, at most, and the time between two of them.
POLLS, POLL_SECONDS = 60, 5.0


def paged(jobs: DataFrame, key: str, poll: Callable[[object, int], str], fetch: Callable[[object, str | None], tuple[list[str], str | None]],
          polls: int = POLLS, wait: float = POLL_SECONDS, parallel: int = PARALLEL) -> DataFrame:
    """(key, page_no, item_no, item, error): the pages of jobs that finish in their own time. A job is polled
    until it is ``done`` or ``failed``, then its pages are followed by their tokens; pages are handed
    on one by one. A job that fails or does not end in time gives one row with the error."""
    kind = jobs.schema[key].dataType.simpleString()
    cols = [key, "page_no", "item_no", "item", "error"]

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for f in frames:
            for k in f[key]:
                state = "waiting"
                for n in range(polls):
                    state = poll(k, n)
                    if state in ("done", "failed"):
                        break
                    time.sleep(wait)
                if state != "done":
                    yield pd.DataFrame([(k, None, None, None, "failed" if state == "failed" else f"not done after {polls} polls")],
                                       columns=cols).astype({"page_no": "Int32", "item_no": "Int32"})
                    continue
                token, page = None, 0
                while True:
                    items, token = fetch(k, token)
                    yield pd.DataFrame([(k, page, i, x, None) for i, x in enumerate(items)], columns=cols).astype({"page_no": "Int32", "item_no": "Int32"})
                    page += 1
                    if token is None:
                        break

    return jobs.select(key).repartition(parallel).mapInPandas(run, f"`{key}` {kind}, page_no int, item_no int, item string, error string")


def embed(df: DataFrame, key: str, value: str, embedder: Callable[[list[str]], list[list[float]]], width: int) -> DataFrame:
    """(key, embedding) in batches; vectors of another width are an error."""
    kind = df.schema[key].dataType.simpleString()

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for f in frames:
            got = embedder(["" if v is None else v for v in f[value]])
            if any(len(g) != width for g in got):
                raise ValueError(f"the embedder gave vectors that are not {width} wide")
            yield pd.DataFrame({key: f[key], "embedding": got})

    return df.select(key, value).mapInPandas(run, f"`{key}` {kind}, embedding array<float>")
