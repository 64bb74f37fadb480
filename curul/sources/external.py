"""Calls to services outside (pages, models) behind one interface: batches, retries, a circuit breaker, a result row each."""

from __future__ import annotations

import time
from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from curul.functions.classify import error_kind

#: Kinds of failure after which no further call is worth it.
FATAL = ("cuota_diaria_agotada", "credenciales_invalidas")


def call_service(rows: DataFrame, key: str, payload: str, service: Callable[[list[str]], list[str]], batch: int = 6, attempts: int = 4, wait: float = 5.0, breaker: int = 3) -> DataFrame:
    """(key, result, error): the service's answer to each payload, in batches of one partition.

    A batch is tried ``attempts`` times, waiting twice as long each time. After ``breaker`` failed batches in a row the
    partition stops calling and the rest gets the error "not attempted". Null payloads are not sent (error "empty").
    Filter before calling: the service is the slow part.
    """
    key_type = rows.schema[key].dataType.simpleString()

    def call(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        failed = 0
        for b in batches:
            out = {k: (None, "empty") for k in b.index[b[payload].isna()]}
            todo = list(b.index[b[payload].notna()])
            for at in range(0, len(todo), batch):
                part = todo[at : at + batch]
                if failed >= breaker:
                    out |= {k: (None, "not attempted") for k in part}
                    continue
                error = ""
                for n in range(attempts):
                    try:
                        answers = service([b[payload][k] for k in part])
                        out |= {k: (a, None) for k, a in zip(part, answers, strict=True)}
                        error, failed = "", 0
                        break
                    except Exception as e:  # noqa: BLE001
                        error = str(e) or type(e).__name__
                        if n + 1 < attempts:
                            time.sleep(wait * 2**n)
                if error:
                    failed += 1
                    out |= {k: (None, error) for k in part}
            yield pd.DataFrame({key: b[key], "result": [out[k][0] for k in b.index], "error": [out[k][1] for k in b.index]})

    return rows.select(key, payload).mapInPandas(call, f"{key} {key_type}, result string, error string")


def with_error_kind(results: DataFrame) -> DataFrame:
    """Adds the kind of each error and whether it is fatal."""
    kind = F.when(F.col("error").isNotNull(), error_kind("error"))
    return results.withColumn("error_kind", kind).withColumn("fatal", F.coalesce(F.col("error_kind").isin(*FATAL), F.lit(False)))
