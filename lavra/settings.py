"""The settings of a harvest: from a mapping such as the environment, or as a table of jobs."""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass, fields

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lavra.functions.rules import TRUE_WORDS, bool_setting, int_setting


@dataclass(frozen=True)
class Settings:
    """The defaults of the search, its cap, the browser, the times in seconds and milliseconds, and attempts."""

    query: str = "Direito"
    max_records: int = 100
    headless: bool = False
    request_timeout: int = 20
    page_timeout: int = 30000
    max_retries: int = 2

    @classmethod
    def of(cls, values: Mapping[str, str], prefix: str = "") -> Settings:
        """From ``values`` with keys such as ``<prefix>MAX_RECORDS``; what is absent or no number keeps its default."""
        out = {}
        for f in fields(cls):
            v = values.get(prefix + f.name.upper())
            if v is None:
                continue
            if isinstance(f.default, bool):
                out[f.name] = v.strip().lower() in TRUE_WORDS
            elif isinstance(f.default, int):
                try:
                    out[f.name] = int(v)
                except ValueError:
                    continue
            else:
                out[f.name] = v
        return cls(**out)


def job_settings(values: DataFrame, job: str = "job", key: str = "key", value: str = "value") -> DataFrame:
    """(``job``, one typed column for each setting) from rows (job, key, value); of a key given twice the greatest value counts.

    Keys are the settings' names in capitals; others are ignored. Jobs without a known key have all defaults.
    """
    wide = values.groupBy(job).agg(*(F.max(F.when(F.col(key) == f.name.upper(), F.col(value))).alias(f.name) for f in fields(Settings)))
    typed = []
    for f in fields(Settings):
        kind = bool_setting if isinstance(f.default, bool) else int_setting if isinstance(f.default, int) else lambda c, d: F.coalesce(c, F.lit(d))
        typed.append(kind(F.col(f.name), f.default).alias(f.name))
    return wide.select(job, *typed)
