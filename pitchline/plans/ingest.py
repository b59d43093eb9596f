"""Whole runs: ingest (load, check, clean, encode and scale, save, report) and feature integration with its reports."""

from __future__ import annotations

import argparse
import logging
import os
import re
import time
import uuid
from contextlib import contextmanager
from dataclasses import dataclass, field, replace
from datetime import datetime, timezone

from py4j.protocol import Py4JJavaError
from pyspark.errors import PySparkException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..errors import FeatureError, PitchlineError
from ..operators import clean as C
from ..operators import preprocess as P
from ..operators import profile as Q
from ..operators import validate as V
from ..schema import MATCHES, SEQ
from ..sources import files as S
from .features import REGISTRY, combine

#: Leagues by code.
LEAGUES = {
    "EPL": {"name": "English Premier League", "country": "England", "competition": "Premier League", "data_provider": "Opta", "source": "Official Premier League"},
    "LA_LIGA": {"name": "LaLiga", "country": "Spain", "competition": "LaLiga", "data_provider": "Opta", "source": "Official LaLiga"},
}
VERSION = "1.1.0"


def league(code: str) -> dict:
    if code.upper() not in LEAGUES:
        raise ValueError(f"no league {code}")
    return {"code": code.upper(), **LEAGUES[code.upper()]}


def league_metadata(code: str, season: str) -> dict:
    """A league's record for a season."""
    found = league(code)
    return {"league": found["code"], "league_name": found["name"], "season": season} | {k: found[k] for k in ("country", "competition", "source", "data_provider")}


@dataclass(frozen=True)
class Settings:
    """Folders (paths or URIs), league and the rest; see load."""

    raw: str = "data/raw"
    processed: str = "data/processed"
    metadata: str = "data/metadata"
    reports: str = "reports"
    league: str = "EPL"
    version: str = VERSION
    seed: int = 42
    logs: str = "logs"

    @classmethod
    def load(cls, env=os.environ, root: str | None = None) -> "Settings":
        """From the environment where it is set; relative folders are under root, if one is given."""
        names = {"raw": "DATA_RAW_PATH", "processed": "DATA_PROCESSED_PATH", "metadata": "DATA_METADATA_PATH", "reports": "REPORT_PATH", "logs": "LOG_PATH", "league": "DEFAULT_LEAGUE", "version": "PIPELINE_VERSION", "seed": "RANDOM_SEED"}
        found = {k: env[v] for k, v in names.items() if env.get(v)}
        s = cls(**{k: int(v) if k == "seed" else v for k, v in found.items()})
        return replace(s, **{k: resolve(getattr(s, k), root) for k in s.folders()}) if root else s

    @staticmethod
    def folders() -> tuple[str, ...]:
        return ("raw", "processed", "metadata", "reports", "logs")

    def ensure(self, spark: SparkSession) -> None:
        """Make the folders that runs write to."""
        S.ensure_directories(spark, [getattr(self, k) for k in self.folders()[1:]])


def resolve(path: str, root: str) -> str:
    """A path as it is if it is a URI or absolute, with ~ for home, else under root."""
    if "://" in path or path.startswith("file:"):
        return path
    path = os.path.expanduser(path)
    return path if os.path.isabs(path) else f"{root.rstrip('/')}/{path}"


class RunLog(logging.LoggerAdapter):
    """A logger whose records carry the run's id and are kept, to be written beside its report."""

    def __init__(self, execution_id: str):
        super().__init__(logging.getLogger("pitchline"), {"execution_id": execution_id})
        self.lines: list[str] = []

    def log(self, level, msg, *args, **kwargs):
        self.lines.append(f"{datetime.now(timezone.utc).isoformat(timespec='milliseconds')} {logging.getLevelName(level)} {self.extra['execution_id']} {msg % args if args else msg}")
        super().log(level, msg, *args, **kwargs)

    def process(self, msg, kwargs):
        return f"[{self.extra['execution_id']}] {msg}", kwargs

    def save(self, spark: SparkSession, directory: str) -> str:
        path = f"{directory}/{self.extra['execution_id']}.log"
        S.save_text(spark, "\n".join(self.lines) + "\n", path)
        return path


@dataclass
class Report:
    execution_id: str
    league: str
    season: str
    status: str = "running"
    steps: dict = field(default_factory=dict)
    rows_removed: int = 0
    duplicate_rows: int = 0
    missing_values_fixed: int = 0
    warnings: list = field(default_factory=list)
    error: str | None = None
    seconds: float = 0.0


def next_version(spark: SparkSession, directory: str, stem: str) -> int:
    fs, p = S._fs(spark, directory)
    names = [s.getPath().getName() for s in fs.listStatus(p)] if fs.exists(p) else []
    return max([int(m[1]) for n in names if (m := re.fullmatch(rf"{re.escape(stem)}_v(\d+)\.json", n))], default=0) + 1


def ingest(spark: SparkSession, paths: list[str], settings: Settings = Settings(), season: str | None = None, now=None) -> Report:
    """Checked, cleaned, encoded and scaled matches as CSV with metadata; a report on success and on failure.

    Scaling and encoding are fitted on all rows here; for models, fit on the training split (operators.preprocess).
    """
    report, began = Report(uuid.uuid4().hex, league(settings.league)["code"], season or str(datetime.now(timezone.utc).year)), time.time()
    stem, log = f"{report.league}_{report.season}".lower(), RunLog(report.execution_id)
    try:
        log.info("loading %d files", len(paths))
        with warnings_of(report, log):
            raw = S.load_matches(spark, paths)
        kept = f"{settings.processed}/{stem}_raw.parquet"
        S.save_dataset(raw, kept, "parquet")  # fixes match_seq
        raw = spark.read.parquet(kept).drop("_file")
        V.check_contracts(raw, now)
        checked = V.validate(raw)
        report.steps["validated"], report.warnings = checked.checks, report.warnings + checked.warnings
        cleaned = C.clean(raw)
        before, after = nulls(raw), nulls(cleaned)
        report.steps["rows"] = {"in": before["rows"], "out": after["rows"]}
        report.rows_removed, report.duplicate_rows = before["rows"] - after["rows"], V.duplicate_rows(raw).first().duplicates
        report.missing_values_fixed = max(0, before["nulls"] - after["nulls"])
        log.info("cleaned: %s", report.steps["rows"])
        classes = P.categories(cleaned, MATCHES.categorical)
        factors = P.scaling(cleaned, MATCHES.numeric)
        final = P.scale(P.label_encode(cleaned, classes), factors)
        S.save_dataset(final, f"{settings.processed}/{stem}.csv")
        S.save_json(spark, classes, f"{settings.processed}/{stem}_label_encoders.json")
        v = next_version(spark, settings.metadata, stem)
        meta = {"id": uuid.uuid4().hex, "version": v, "league": league_metadata(report.league, report.season), "rows": report.steps["rows"]["out"], "columns": final.columns, "checksum": S.checksum(spark, f"{settings.processed}/{stem}.csv"), "created": datetime.now(timezone.utc), "pipeline": settings.version}
        S.save_json(spark, meta, f"{settings.metadata}/{stem}_v{v}.json")
        report.status = "ok"
    except Exception as e:
        report.status, report.error = "failed", f"{type(e).__name__}: {str(e).splitlines()[0] if str(e) else ''}"
        log.error(report.error)
        raise
    finally:
        report.seconds = round(time.time() - began, 3)
        S.save_json(spark, report.__dict__, f"{settings.reports}/{stem}_{report.execution_id}.json")
        log.save(spark, settings.logs)
    return report


@contextmanager
def warnings_of(report: Report, log: RunLog):
    """Warnings of the loader's logger go to the report too."""

    class Keep(logging.Handler):
        def emit(self, record):
            report.warnings.append(record.getMessage())
            log.lines.append(f"{datetime.now(timezone.utc).isoformat(timespec='milliseconds')} {record.levelname} {report.execution_id} {record.getMessage()}")

    keep = Keep(logging.WARNING)
    S.log.addHandler(keep)
    try:
        yield
    finally:
        S.log.removeHandler(keep)


def nulls(df: DataFrame) -> dict:
    """Rows, and nulls in all their columns but match_seq."""
    r = df.agg(F.count("*").alias("n"), *[F.sum(F.col(f"`{c}`").isNull().cast("long")) for c in df.columns if c != SEQ]).first()
    return {"rows": r[0], "nulls": sum(x or 0 for x in r[1:])}


def integrate(matches: DataFrame, generators=None, target: str | None = None, out: str | None = None) -> tuple[DataFrame, dict]:
    """(matches with all generators' prefixed columns, reports): manifest, quality, benchmark and time integrity.

    Time integrity: shifting the scores of all matches from the median date on must not change a strict generator's
    features up to that date, nor a running one's before it.
    """
    spark, whole = matches.sparkSession, matches
    manifest, seconds = [], {}
    generators = generators if generators is not None else REGISTRY.instances()
    n = matches.count()
    for g in generators:
        g.check(matches)
        began = time.time()
        f = g.generate(matches)
        if f.count() != n:
            raise FeatureError(f"{g.name} returned other rows than it was given")
        named = f.select(SEQ, *[F.col(f"`{c}`").alias(f"{g.name}::{c}") for c in f.columns if c != SEQ])
        whole = combine(whole, named)
        seconds[g.name] = round(time.time() - began, 6)
        manifest.append({"generator": g.name, "columns": [c for c in named.columns if c != SEQ], "window": g.window})
    features = whole.select(SEQ, *[c for m in manifest for c in m["columns"]], *([target] if target else []))
    quality = Q.profile(features.drop(SEQ), target)
    reports = {"manifest": manifest, "quality": quality.__dict__ | {"is_valid": quality.is_valid}, "benchmark": {"generators": seconds, "total": round(sum(seconds.values()), 6)}, "time_integrity": {g.name: no_leak(matches, g) for g in generators if {"FTHG", "FTAG", "Date"} <= set(matches.columns)}}
    for name, r in reports.items() if out else ():
        S.save_json(spark, r, f"{out}/{name}.json")
    return whole, reports


def no_leak(matches: DataFrame, g) -> bool:
    """Whether a generator's features of earlier matches stay the same when later scores change."""
    middle = matches.agg(F.percentile_approx(F.col("Date").cast("timestamp"), 0.5)).first()[0]
    if middle is None:
        return True
    day = F.lit(middle).cast(matches.schema["Date"].dataType)
    later = F.col("Date") >= day
    changed = matches.withColumns({c: F.when(later, F.col(c) + 7).otherwise(F.col(c)) for c in ("FTHG", "FTAG")})
    if "FTR" in matches.columns:
        changed = changed.withColumn("FTR", F.when(later, F.when(F.col("FTR") == "H", "A").otherwise("H")).otherwise(F.col("FTR")))
    early = matches.where(F.col("Date") < day).select(SEQ)
    a, b = (g.generate(x).join(early, SEQ, "left_semi") for x in (matches, changed))
    return a.exceptAll(b).limit(1).count() == 0


def main(argv=None) -> int:
    from ..session import session

    p = argparse.ArgumentParser(prog="pitchline", description="Ingest match CSV files.")
    p.add_argument("--raw")
    p.add_argument("--league")
    p.add_argument("--season")
    a = p.parse_args(argv)
    s = Settings.load()
    s = replace(s, **{k: v for k, v in (("raw", a.raw), ("league", a.league)) if v})
    spark = session()
    try:
        s.ensure(spark)
        r = ingest(spark, S.discover_csv(spark, s.raw), s, a.season)
    except (PitchlineError, PySparkException, Py4JJavaError, ValueError) as e:
        print(f"failed: {str(e).splitlines()[0]}")
        return 1
    print(f"{r.status}: {r.steps}")
    return 0


if __name__ == "__main__":
    raise SystemExit(main())
