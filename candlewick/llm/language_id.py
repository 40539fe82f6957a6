"""Language identification by rank-order profiles.

A language's profile is its ``top`` most frequent character n-grams (1 to 3
characters inside words, words padded with one space) over all training texts;
a document is ranked the same way and gets the language whose profile is
nearest by out-of-place distance: the sum over the document's n-grams of the
difference of ranks, or ``top`` for an n-gram the profile lacks.

N-grams are 64-bit codes counted with numpy in each task; training sends one
row per language and n-gram and task.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from candlewick.llm.common import fold, hidden, pick, position
from candlewick.llm.workers import release_memory
from candlewick.session import ship_package

TOP = 300
UNDETERMINED = "und"
MAX_LANGUAGES = 1000
QUANTILE, MARGIN = 0.001, 0.75  # see calibrated_score
CHUNK_CHARS, FLUSH_GRAMS = 1 << 18, 1 << 19
_SPACE = 32


@lru_cache(maxsize=1)
def _letters() -> np.ndarray:
    """For each code point: is it a letter (Unicode category L*)?"""
    import unicodedata

    return np.array([unicodedata.category(chr(c))[0] == "L" for c in range(0x110000)], bool)


def letters_only(text: str) -> np.ndarray:
    """Code points of the lower-cased text, every run of anything but letters
    turned into one space, with a space at both ends; empty without a letter."""
    points = np.frombuffer(text.lower().encode("utf-32-le"), "<u4")
    is_letter = _letters()[points]
    if not is_letter.any():
        return np.empty(0, np.uint64)
    out = np.where(is_letter, points, _SPACE)
    keep = is_letter.copy()
    keep[1:] |= is_letter[:-1]  # the first of each run
    body = out[keep]
    return np.pad(body, (1, int(is_letter[-1])), constant_values=_SPACE).astype(np.uint64)


def ngram_counts(points: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Codes and counts of the 1- to 3-grams inside padded words."""
    if not len(points):
        return np.empty(0, np.uint64), np.empty(0, np.int64)
    shift, space = np.uint64(21), np.uint64(_SPACE)
    inner = points != space
    two = (points[:-1] << shift) | points[1:]  # runs of spaces do not occur
    three = (two[:-1] << shift) | points[2:]
    codes = np.concatenate([points[inner], two, three[inner[1:-1]]])
    return np.unique(codes, return_counts=True)


def text_of(code: int) -> str:
    out = ""
    while code:
        out, code = chr(code & 0x1FFFFF) + out, code >> 21
    return out


def train_profiles(docs: DataFrame, text_col: str = "text", lang_col: str = "lang", top: int = TOP) -> DataFrame:
    """``lang, gram, rank`` (rank from 0): the ``top`` n-grams of each language
    over all texts with a language; ties by n-gram code. At most
    languages x ``top`` rows."""
    ship_package(docs.sparkSession)
    small = pick(docs, lang_col, text_col).toDF("lang", "text").where("lang IS NOT NULL AND text IS NOT NULL")

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        waiting: dict[str, list] = {}
        chars: dict[str, int] = {}
        sums: dict[str, tuple[np.ndarray, np.ndarray]] = {}

        def add(lang: str) -> None:
            codes, n = ngram_counts(np.concatenate(waiting.pop(lang)))
            if lang in sums:
                codes, back = np.unique(np.concatenate([sums[lang][0], codes]), return_inverse=True)
                n = np.bincount(back, np.concatenate([sums[lang][1], n]).astype(float)).astype(np.int64)
            sums[lang] = (codes, n)
            chars[lang] = 0

        def out() -> Iterator[pa.RecordBatch]:
            for lang, (codes, n) in sums.items():
                yield pa.RecordBatch.from_arrays(
                    [pa.array([lang] * len(codes), pa.string()), pa.array(codes.astype(np.int64)), pa.array(n)], names=["lang", "gram", "n"]
                )
            sums.clear()

        for batch in batches:
            for lang, text in zip(batch.column("lang").to_pylist(), batch.column("text")):
                points = letters_only(text.as_py())
                if not len(points):
                    continue
                # texts meet at a single space: neighbours share no n-gram
                waiting.setdefault(lang, []).append(points if not waiting.get(lang) else points[1:])
                chars[lang] = chars.get(lang, 0) + len(points)
                if chars[lang] >= CHUNK_CHARS:
                    add(lang)
            if sum(len(c) for c, _ in sums.values()) >= FLUSH_GRAMS:
                yield from out()
        for lang in list(waiting):
            add(lang)
        yield from out()
        release_memory()

    counts = small.mapInArrow(count, "lang string, gram long, n long").groupBy("lang", "gram").agg(F.sum("n").alias("n"))
    order = Window.partitionBy("lang").orderBy(F.col("n").desc(), "gram")
    return counts.withColumn("rank", F.row_number().over(order) - 1).where(F.col("rank") < top).select("lang", "gram", "rank")


class Profiles:
    """All profiles as one table of ranks: a row per n-gram, a column per
    language."""

    def __init__(self, rows: list[tuple[str, int, int]], top: int):
        self.top = top
        self.langs = sorted({lang for lang, _, _ in rows}, key=lambda s: s.encode())
        self.grams = np.unique(np.array([g for _, g, _ in rows], np.uint64))
        self.ranks = np.full((len(self.grams) + 1, len(self.langs)), -1, np.int32)
        column = {lang: i for i, lang in enumerate(self.langs)}
        for lang, gram, rank in rows:
            self.ranks[np.searchsorted(self.grams, np.uint64(gram)), column[lang]] = rank

    def predict(self, text: str | None) -> tuple[str, float]:
        """The nearest language (first by code point on a tie) and
        1 - distance / largest possible distance."""
        points = letters_only(text or "")
        if not len(points) or not self.langs:
            return UNDETERMINED, 0.0
        codes, n = ngram_counts(points)
        if len(codes) > self.top:  # ties by code, as in the profiles
            codes = codes[np.lexsort((codes, -n))[: self.top]]
        else:
            codes = codes[np.lexsort((codes, -n))]
        at = np.minimum(np.searchsorted(self.grams, codes), len(self.grams) - 1)
        found = np.where(self.grams[at] == codes, at, len(self.grams))
        ranks = self.ranks[found]
        apart = np.abs(ranks - np.arange(len(codes), dtype=np.int32)[:, None])
        distance = np.where(ranks < 0, self.top, apart).sum(0)
        best = int(np.argmin(distance))
        return self.langs[best], 1.0 - float(distance[best]) / (self.top * len(codes))


def collect_profiles(trained: DataFrame, top: int = TOP, max_languages: int = MAX_LANGUAGES) -> Profiles:
    """Profiles on the driver: at most ``max_languages`` x ``top`` rows; more
    languages are an error, not a cut."""
    rows = [tuple(r) for r in trained.take(max_languages * top + 1)]
    if len(rows) > max_languages * top:
        raise ValueError(f"over {max_languages} languages: raise max_languages or clean the labels")
    return Profiles(rows, top)


def predict_languages(docs: DataFrame, profiles: Profiles, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """All columns of ``docs`` (hidden names ``_inN``) plus ``lang_pred`` and
    ``score`` (0 to 1); ``und`` with score 0 if the text is null or has no
    letter, or if no language was learned. Rows are independent."""
    spark = docs.sparkSession
    ship_package(spark)
    raw, names = hidden(docs)
    text = position(names, text_col)
    shared = spark.sparkContext.broadcast(profiles)  # languages x top rows
    schema = T.StructType([*raw.schema.fields, T.StructField("lang_pred", T.StringType()), T.StructField("score", T.DoubleType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        predict = shared.value.predict
        for batch in batches:
            got = [predict(t.as_py()) for t in batch.column(text)]
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, pa.array([g[0] for g in got], pa.string()), pa.array([g[1] for g in got], pa.float64())], names=schema.names
            )
        release_memory()

    return raw.mapInArrow(run, schema)


def learn(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    lang_col: str = "lang",
    folds: int = 4,
    held_fold: int = 2,
    top: int = TOP,
) -> Profiles:
    """Profiles of the rows of ``docs`` with a language that are not held out."""
    train = pick(docs, id_col, text_col, lang_col).toDF("doc_id", "text", "lang").where(fold(F.col("doc_id"), folds) != held_fold)
    return collect_profiles(train_profiles(train, top=top), top)


def identify(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    lang_col: str = "lang",
    folds: int = 4,
    held_fold: int = 2,
    top: int = TOP,
) -> DataFrame:
    """Train on the rows of ``docs`` with a language whose id's fold (crc32 of
    the id as text, modulo ``folds``) is not ``held_fold``; predict all rows:
    columns of ``docs`` under hidden names, ``held_out, lang_pred, score``.

    The label is no input of a prediction. Without labelled rows everything
    is ``und``; an empty table gives an empty result; a null id is in fold 0.
    Whole texts are ranked however long they are; repeated rows are learned
    from each and get equal predictions.
    """
    _, names = hidden(docs)
    profiles = learn(docs, id_col, text_col, lang_col, folds, held_fold, top)
    return predict_languages(docs, profiles, id_col, text_col).withColumn(
        "held_out", fold(F.col(position(names, id_col)), folds) == held_fold
    )


def with_letters(docs: DataFrame, text_col: str = "text") -> DataFrame:
    """The rows of ``docs`` (hidden names ``_inN``) whose text has a letter."""
    ship_package(docs.sparkSession)
    raw, names = hidden(docs)
    text = position(names, text_col)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield batch.filter(pa.array([len(letters_only(t.as_py() or "")) > 0 for t in batch.column(text)], pa.bool_()))

    return raw.mapInArrow(run, raw.schema)


def calibrated_score(scored: DataFrame, lang: str, quantile: float = QUANTILE, margin: float = MARGIN) -> float:
    """The least score of a text in a learned language: ``margin`` times the
    ``quantile`` of the scores of ``scored`` (texts that were not learned from,
    with ``lang_pred, score`` and their label in column ``lang``) whose
    language was told rightly; 0 if there is none to calibrate by. Texts in
    other languages and random letters share few frequent n-grams with any
    profile and score well below."""
    right = scored.where(F.col("lang_pred") == F.col(lang))
    least = right.agg(F.percentile_approx("score", quantile, 10_000)).first()[0]
    return margin * least if least is not None else 0.0


def keep_identified(
    docs: DataFrame,
    min_score: float | None = None,
    id_col: str = "doc_id",
    text_col: str = "text",
    lang_col: str = "lang",
    folds: int = 4,
    held_fold: int = 2,
    top: int = TOP,
) -> DataFrame:
    """The rows of ``docs`` in one of the learned languages, with the columns of
    ``docs``: their language could be told (not ``und``) with a score of at
    least ``min_score``. By default that is calibrated on the held-out labelled
    rows (``calibrated_score``).

    A null text or one without a letter goes. Where no language was learned
    there is nothing to tell by, and only the rows without a letter go. Whole
    texts are ranked however long they are; repeated rows are judged alike; an
    empty table gives an empty result; extra columns stay, whatever their names.
    """
    _, names = hidden(docs)
    profiles = learn(docs, id_col, text_col, lang_col, folds, held_fold, top)
    if profiles.langs:
        if min_score is None:
            lang = position(names, lang_col)
            unseen = hidden(docs)[0].where((fold(F.col(position(names, id_col)), folds) == held_fold) & F.col(lang).isNotNull())
            min_score = calibrated_score(predict_languages(unseen, profiles, position(names, id_col), position(names, text_col)), lang)
        out = predict_languages(docs, profiles, id_col, text_col).where((F.col("lang_pred") != UNDETERMINED) & (F.col("score") >= min_score))
    else:
        out = with_letters(docs, text_col)
    return out.select(*[f"_in{i}" for i in range(len(docs.columns))]).toDF(*docs.columns)
