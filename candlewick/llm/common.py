"""Column picking and folds shared by the corpus operators."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Words of the corpus contracts: maximal runs without ASCII white space.
WORD = r"[^\x20\x09-\x0D]+"
UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"


def table(spark, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def hidden(df: DataFrame) -> tuple[DataFrame, list[str]]:
    """``df`` with its columns renamed by position (``_in0``, ``_in1``, ...),
    so that no extra column can clash with an operator's own columns (equal
    names, or names that differ in case only), and the original names."""
    return df.toDF(*[f"_in{i}" for i in range(len(df.columns))]), list(df.columns)


def position(names: list[str], name: str) -> str:
    """The hidden name of column ``name`` (the exact match, else the only match
    regardless of case)."""
    if name in names:
        return f"_in{names.index(name)}"
    loose = [i for i, n in enumerate(names) if n.lower() == name.lower()]
    if len(loose) != 1:
        raise ValueError(f"column {name!r} not found among {names}")
    return f"_in{loose[0]}"


def pick(df: DataFrame, *names: str) -> DataFrame:
    """Only the named columns, whatever else ``df`` carries."""
    raw, had = hidden(df)
    return raw.select(*[F.col(position(had, n)).alias(n) for n in names])


def lower_ascii(c: Column) -> Column:
    """Lower-case A-Z and nothing else."""
    return F.translate(c, UPPER, UPPER.lower())


def fold(doc_id: Column, modulus: int) -> Column:
    """crc32 of the id as text, modulo ``modulus`` (a null id counts as empty)."""
    return F.crc32(F.coalesce(doc_id.cast("string"), F.lit("")).cast("binary")) % F.lit(modulus)


#: Letters of the plain texts that tokenizers split on a fast path: ASCII and
#: the Latin-1 letters (each is one code point in composed form).
PLAIN_LETTERS = "A-Za-zÀ-ÖØ-öø-ÿ"
NOT_PLAIN = rf"[^\x00-\x7f{PLAIN_LETTERS}]"
