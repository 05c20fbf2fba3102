"""Results of outside services: lines of a video probe, and backends given as callables."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


def video_probe(line: Column) -> Column:
    """struct(id, upload_date, duration, title) of a probe's tab-separated line; null if it has fewer than four fields."""
    parts = F.split(F.trim(line), "\t")
    date, seconds = F.nullif(F.get(parts, F.lit(1)), F.lit("")), F.get(parts, F.lit(2))
    return F.when(F.size(parts) >= 4, F.struct(F.get(parts, F.lit(0)).alias("id"), date.alias("upload_date"), F.when(seconds.rlike("^[0-9]+$"), seconds.try_cast("int")).alias("duration"), F.get(parts, F.lit(3)).alias("title")))


def backend(rows: DataFrame, call: Callable[[dict], dict | None], schema: str | T.StructType, kept: list[str]) -> DataFrame:
    """``rows``'s ``kept`` columns with what ``call`` returns for each row (speech, vision, conversion), typed by ``schema``, and ``error``.

    A call that raises gives nulls and its message, so one bad file fails no job; None gives nulls alone.
    """
    fields = T._parse_datatype_string(schema) if isinstance(schema, str) else schema
    out = T.StructType([*[rows.schema[c] for c in kept], *fields.fields, T.StructField("error", T.StringType())])
    names = [f.name for f in fields.fields]

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            made = []
            for row in frame.to_dict("records"):
                try:
                    got, error = call(row) or {}, None
                except Exception as e:  # noqa: BLE001  (whatever an outside service raises)
                    got, error = {}, f"{type(e).__name__}: {e}"
                made.append([*(row[c] for c in kept), *(got.get(n) for n in names), error])
            yield pd.DataFrame(made, columns=[*kept, *names, "error"])

    return rows.mapInPandas(run, out)
