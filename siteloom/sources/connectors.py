"""External services. Replays are joins with logged tables; a live client is one object a partition, in ``mapInPandas``."""

from __future__ import annotations

import time
from collections.abc import Callable, Iterator
from typing import Any, Protocol

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F


class Client(Protocol):
    def __call__(self, request: dict[str, Any]) -> str: ...


class Failure(Exception):
    """status: of the service. fatal: a wrong configuration, which ends the run."""

    def __init__(self, status: int, text: str = "", fatal: bool = False):
        super().__init__(text or str(status))
        self.status, self.fatal = status, fatal


def attempt(client: Callable[[dict, str], str], request: dict, models: list[str], first: int = 0, retries: int = 3, pause: float = 15.0, sleep=time.sleep) -> dict:
    """One request: retries with a growing pause, and the next model where one is gone or stays busy.

    404 goes on at once; 429 and 529 go on after the retries; 500 and 503 are retried and then are an error; others
    are an error. Returns reply, model, attempt, error and the place of the model that later requests begin with.
    """
    at, tries = first, 0
    while True:
        busy = None
        for n in range(1, retries + 1):
            tries += 1
            try:
                return {"reply": client(request, models[at]), "model": models[at], "attempt": tries, "error": None, "at": at}
            except Failure as e:
                if e.fatal or e.status == 404 and at + 1 == len(models):
                    raise
                busy = e
                if e.status not in (429, 500, 503, 529):
                    break
                if n < retries:
                    sleep(pause * n)
        if busy.status in (404, 429, 529) and at + 1 < len(models):
            at += 1
            continue
        return {"reply": None, "model": models[at], "attempt": tries, "error": str(busy), "at": at}


def call(requests: DataFrame, make: Callable[[], Callable[[dict, str], str]], models: list[str], pace: float = 0.0, pause: float = 15.0) -> DataFrame:
    """requests: id, stage, payload. One reply or error a row; a row never fails the job. Write the result before it is used twice."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        client, at, last = make(), 0, 0.0
        for batch in batches:
            rows = []
            for r in batch.itertuples(index=False):
                if pace and (wait := last + pace - time.monotonic()) > 0:
                    time.sleep(wait)
                last = time.monotonic()
                try:
                    got = attempt(client, {"id": r.id, "stage": r.stage, "payload": r.payload}, models, at, pause=pause)
                    at = got["at"]
                except Failure as e:
                    if e.fatal:
                        raise
                    got = {"reply": None, "model": models[at], "attempt": 1, "error": str(e)}
                except Exception as e:  # an error of a row is data
                    got = {"reply": None, "model": models[at], "attempt": 1, "error": f"{type(e).__name__}: {e}"}
                rows.append((r.id, r.stage, got["model"], got["attempt"], got["reply"], got["error"]))
            yield pd.DataFrame(rows, columns=["id", "stage", "model", "attempt", "raw", "error"])

    return requests.select("id", "stage", "payload").mapInPandas(run, "id string, stage string, model string, attempt int, raw string, error string")


def dispatch(stage: str, primary: str = "primary", secondary: str = "secondary") -> dict[str, str]:
    """What a stage is asked with: the provider, the prompt, and the tool (or schema) of the answer."""
    kind = "scan" if stage == "scan" else "recheck" if stage.endswith("_recheck") else "zoom" if stage == "zoom" else "classify"
    return {
        "provider": secondary if "escalate" in stage else primary, "prompt": {"classify": "classification", "recheck": "equipment", "zoom": "zoom", "scan": "scan"}[kind],
        "tool": "scan_candidates" if kind == "scan" else "classify_site", "schema": "SCAN" if kind == "scan" else "REPLY",
    }


def tile(get: Callable[[str], tuple[int, bytes | None]], url: str, tries: int = 3, pause: float = 2.0, sleep=time.sleep) -> tuple[int, bytes | None]:
    """Status and bytes of one tile: what is busy (429, 502, 503) is asked for again, after a growing pause."""
    for n in range(1, tries + 1):
        status, data = get(url)
        if status not in (429, 502, 503) or n == tries:
            return status, data if status == 200 else None
        sleep(pause * n)
    raise AssertionError


def tiles(plan: DataFrame, make: Callable[[], Callable[[str], tuple[int, bytes | None]]], url: str, pause: float = 2.0) -> DataFrame:
    """A tile plan (id, view, z, x, y) with the status and bytes of each tile; url has these names in braces. A tile that fails is a status, not an error of the job."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        get = make()
        for batch in batches:
            rows = []
            for r in batch.itertuples(index=False):
                try:
                    status, data = tile(get, url.format(view=r.view, z=r.z, x=r.x, y=r.y), pause=pause)
                except Exception:  # no answer at all
                    status, data = 0, None
                rows.append((r.id, r.view, r.z, r.x, r.y, status, data))
            yield pd.DataFrame(rows, columns=["id", "view", "z", "x", "y", "status", "data"])

    return plan.select("id", "view", "z", "x", "y").mapInPandas(run, "id string, view string, z int, x int, y int, status int, data binary")


def replay(requests: DataFrame, log: DataFrame) -> DataFrame:
    """The logged reply of each request: of several attempts the last."""
    last = log.groupBy("id", "stage").agg(F.max_by(F.struct("model", "attempt", "raw", "error"), "attempt").alias("_l"))
    return requests.select("id", "stage").join(last, ["id", "stage"], "left").select(
        "id", "stage", "_l.model", "_l.attempt", "_l.raw", F.when(F.col("_l").isNull(), "no logged reply").otherwise(F.col("_l.error")).alias("error")
    )
