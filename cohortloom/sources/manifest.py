"""Record lists: header harmonisation and download manifests."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# --- Fixed values: which header fragments name which column. ---
RECORD_RULES = (
    ("subject_id", ("subject",)),
    ("study_id", ("study",)),
    ("path", ("path", "filename", "record")),
    ("ecg_time", ("ecg_time", "chartdate", "start")),
)
MANIFEST_COLUMNS = ("hadm_id", "subject_id", "label", "study_id", "path")
RECORD_EXTENSIONS = (".hea", ".dat")


def harmonise_columns(
    df: DataFrame, rules: Sequence[tuple[str, Sequence[str]]] = RECORD_RULES
) -> DataFrame:
    """Canonical column names by header fragment; the first matching rule wins.

    Two headers that claim the same name are an error rather than a guess.
    """
    def canonical(header: str) -> str:
        text = header.lower().strip()
        return next((name for name, parts in rules if any(p in text for p in parts)), text)

    names = [canonical(c) for c in df.columns]
    repeated = sorted({n for n in names if names.count(n) > 1})
    if repeated:
        raise ValueError(f"several columns map to {', '.join(repeated)}: {df.columns}")
    return df.toDF(*names)


def manifest(matched: DataFrame) -> DataFrame:
    return matched.select(*[c for c in MANIFEST_COLUMNS if c in matched.columns])


def file_manifest(matched: DataFrame, path: str = "path",
                  extensions: Sequence[str] = RECORD_EXTENSIONS) -> DataFrame:
    """One row per distinct record path and file extension."""
    stem = F.col(path)
    for extension in extensions:
        stem = F.replace(stem, F.lit(extension), F.lit(""))
    # Records listed under several of their files have one stem.
    listed = matched.where(F.col(path).isNotNull()).select(stem.alias("_stem")).distinct()
    endings = F.array(*[F.lit(e) for e in extensions])
    return listed.select(
        F.explode(F.transform(endings, lambda e: F.concat("_stem", e))).alias("file"))


def write_manifest(matched: DataFrame, folder: str) -> None:
    manifest(matched).write.mode("overwrite").csv(f"{folder}/manifest", header=True)
    if "path" in matched.columns:
        file_manifest(matched).write.mode("overwrite").text(f"{folder}/files")
