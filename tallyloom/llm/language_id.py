"""Language identification: multinomial naive Bayes over hashed character n-grams.

Texts are lower-cased, everything but letters counts as one space, and the n-grams of one to
three characters are hashed into a fixed number of buckets. Training adds up bucket counts per
language over all labelled texts: inside each task first, then by a shuffle of at most
``BUCKETS`` rows per language and task. The model is a matrix of log-probabilities, languages by buckets, with
a prior per language; its size depends on the number of languages alone, which is checked
before it is broadcast. Scoring turns a text into its sparse bucket counts and multiplies them
with the matrix in numpy.

Defined cases: a NULL text or one without a letter is ``und`` with score 0; an empty training
set gives ``und`` for everything; ties go to the first language by name.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyloom.llm.common import fold, text_batches

BUCKET_BITS = 14
BUCKETS = 1 << BUCKET_BITS
LONGEST = 3
SMOOTHING = 0.5
FOLDS, HELD_OUT = 5, 0
UNKNOWN = "und"
MAX_LANGUAGES = 500  # a model of at most 33 MB
CHUNK_BYTES = 4 << 20
LETTER = re.compile(r"[^\W\d_]")
FACTORS = np.array([0x9E3779B1, 0x85EBCA77, 0xC2B2AE3D], dtype=np.uint32)  # odd, for mixing
# Code points that are no letters become spaces; above Latin-1 all count as letters.
LETTERS = np.array([ord(chr(c).lower()[0]) if chr(c).isalpha() else 32 for c in range(256)], dtype=np.uint32)


def ngram_buckets(text: str) -> np.ndarray:
    """The bucket of every n-gram of a text, one length after the other."""
    codes = np.frombuffer(text.lower().encode("utf-32-le", "surrogatepass"), dtype=np.uint32)
    codes = np.where(codes < 256, LETTERS[np.minimum(codes, 255)], codes)
    space = codes == 32
    keep = ~space
    keep[1:] |= ~space[:-1]  # one space for many
    codes = codes[keep]
    found, total = [], np.zeros(len(codes), dtype=np.uint32)
    for length in range(min(LONGEST, len(codes))):
        total = (total[:len(codes) - length] * FACTORS[1]) + (codes[length:] + np.uint32(1)) * FACTORS[0]
        mixed = total ^ (total >> np.uint32(15))
        mixed = (mixed * FACTORS[2]) >> np.uint32(32 - BUCKET_BITS)
        found.append(mixed)
    return np.concatenate(found) if found else np.empty(0, dtype=np.uint32)


def count_task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(lang, bucket, n) of the task, and with bucket -1 the number of texts."""
    totals: dict[str, np.ndarray] = {}

    def counted() -> pa.RecordBatch:
        langs, buckets, numbers = [], [], []
        for lang, total in totals.items():
            used = np.flatnonzero(total)
            langs += [lang] * len(used)
            buckets.append(used - 1)
            numbers.append(total[used])
        return pa.RecordBatch.from_arrays(
            [pa.array(langs, pa.string()),
             pa.array(np.concatenate(buckets) if buckets else [], pa.int32()),
             pa.array(np.concatenate(numbers) if numbers else [], pa.int64())],
            names=["lang", "bucket", "n"])

    for batch in text_batches(batches, CHUNK_BYTES):
        for lang, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
            total = totals.setdefault(lang, np.zeros(BUCKETS + 1, dtype=np.int64))
            total[0] += 1
            total[1:] += np.bincount(ngram_buckets(text), minlength=BUCKETS)
        if len(totals) > MAX_LANGUAGES:
            yield counted()
            totals.clear()
    yield counted()


class Model:
    """Log-probabilities of buckets by language, and of the languages."""

    def __init__(self, counts: DataFrame):
        """``counts`` has at most MAX_LANGUAGES * (BUCKETS + 1) rows, which is checked first."""
        self.langs = sorted(row["lang"] for row in counts.where("bucket = -1")
                            .select("lang").limit(MAX_LANGUAGES + 1).collect())
        if len(self.langs) > MAX_LANGUAGES:
            raise ValueError(f"more than {MAX_LANGUAGES} languages")
        place = {lang: k for k, lang in enumerate(self.langs)}
        texts = np.zeros(len(self.langs))
        totals = np.zeros((BUCKETS, len(self.langs)))
        for row in counts.groupBy("lang").agg(
                F.collect_list("bucket").alias("bucket"), F.collect_list("n").alias("n")).toLocalIterator():
            buckets, numbers = np.array(row["bucket"]), np.array(row["n"], dtype=np.float64)
            texts[place[row["lang"]]] = numbers[buckets < 0].sum()
            totals[buckets[buckets >= 0], place[row["lang"]]] = numbers[buckets >= 0]
        smooth = totals + SMOOTHING
        self.weights = np.log(smooth / smooth.sum(axis=0, keepdims=True)).astype(np.float32)
        self.prior = np.log(texts / max(texts.sum(), 1.0)) if len(texts) else texts

    def predict(self, text: str | None) -> tuple[str, float]:
        if text is None or not self.langs or not LETTER.search(text):
            return UNKNOWN, 0.0
        counts = np.bincount(ngram_buckets(text), minlength=BUCKETS)
        used = np.flatnonzero(counts)
        logs = counts[used].astype(np.float64) @ self.weights[used] + self.prior
        best = int(np.argmax(logs))
        return self.langs[best], float(1.0 / np.exp(logs - logs[best]).sum())


def fit_language_model(labelled: DataFrame) -> Model:
    """A model of all rows of ``labelled`` (text, lang); rows with a NULL are left out."""
    rows = labelled.select("lang", "text").where(F.col("lang").isNotNull() & F.col("text").isNotNull())
    counts = (rows.mapInArrow(count_task, "lang string, bucket int, n long")
              .groupBy("lang", "bucket").agg(F.sum("n").alias("n")))
    return Model(counts)


def training_rows(documents: DataFrame) -> DataFrame:
    return documents.select("doc_id", "text", "lang").where(fold("doc_id", FOLDS) != HELD_OUT)


def predict_languages(table: DataFrame, model: Model) -> DataFrame:
    """``table`` with ``lang_pred`` and ``score``, read from its column ``text`` alone."""
    shared = table.sparkSession.sparkContext.broadcast(model)
    names = [name for name in table.columns if name not in ("lang_pred", "score")]
    at = names.index("text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = shared.value
        for batch in text_batches(batches, CHUNK_BYTES):
            found = [model.predict(text) for text in batch.column(at).to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, pa.array([lang for lang, _ in found], pa.string()),
                 pa.array([score for _, score in found], pa.float64())],
                names=[*names, "lang_pred", "score"])

    chosen = table.select(*names)
    fields = ", ".join(f"`{field.name}` {field.dataType.simpleString()}" for field in chosen.schema)
    return chosen.mapInArrow(run, f"{fields}, lang_pred string, score double")


def identify_languages(documents: DataFrame) -> DataFrame:
    """(doc_id, held_out, lang_pred, score) of all rows, by a model of the rows of the other
    folds."""
    model = fit_language_model(training_rows(documents))
    rows = documents.select("doc_id", "text", (fold("doc_id", FOLDS) == HELD_OUT).alias("held_out"))
    return predict_languages(rows, model).select("doc_id", "held_out", "lang_pred", "score")
