"""Language identification with averaged hashed subword embeddings.

A text is its byte n-grams, hashed into ``BUCKETS`` rows of an embedding
table. The mean of the rows goes through a linear softmax. Both tables are
trained by stochastic gradient descent in numpy on a bounded sample: at most
``PER_LANGUAGE`` different texts of each language, those with the smallest
hashes, and fewer of each where there are so many languages that their texts would be more than ``MOST_SAMPLED``. A fifth of them is held back to calibrate: one temperature makes the
score a probability, and the smallest score above which ``PRECISION`` of the
held-back texts are right becomes the limit of acceptance.

Prediction needs only the product of the two tables, a few numbers per bucket,
and runs batch by batch over whole texts without a shuffle.

Defined cases: a text that is null or has no letter is ``und`` with score 0
and not accepted. Rows without a language, id or text are predicted like any
other and not learned from if language or text is missing; a null id counts as
the empty text when folds are dealt. Repeated rows give equal predictions and are
learned from once. An empty table gives no rows; with nothing to learn from,
all is ``und``. A very long text is as many numbers as there are buckets where it is learned from,
and is predicted whole. Other columns are left out.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm.common import table
from tidemark.llm.registry import query
from tidemark.llm.tokens import mix
from tidemark.operators.scale import first_rows
from tidemark.session import store

BUCKETS = 1 << 14
DIMENSIONS = 16
GRAMS = (1, 2, 3, 4)
PER_LANGUAGE = 400
MOST_SAMPLED = 16_000  # texts of all languages together; beyond, each language gives an equal part
EPOCHS, RATE, BATCH = 12, 0.5, 32
PRECISION = 0.99
_PIECE = 1 << 19


def buckets_of(texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """The bucket of every subword of the texts in turn, and where each text starts."""
    raw = [b" " + " ".join(t.lower().split()).encode("utf-8", "surrogatepass") + b" " for t in texts]
    sizes = np.array([len(r) for r in raw])
    b = np.frombuffer(b"".join(raw), np.uint8).astype(np.uint64)
    place = np.concatenate([[0], np.cumsum(sizes)])
    left = np.repeat(place[1:], sizes) - np.arange(len(b))  # bytes to the end of the text
    parts = []
    code = np.zeros(len(b), np.uint64)
    for n in GRAMS:
        code[: len(b) - n + 1] = (code[: len(b) - n + 1] << np.uint64(8)) | b[n - 1 :]
        bucket = (mix(code, n) & np.uint64(BUCKETS - 1)).astype(np.int32)
        parts.append(np.where(left >= n, bucket, BUCKETS).astype(np.int32))  # the last row is empty
    return np.stack(parts, axis=1), place[:-1]


def _pieces(texts: list[str]) -> Iterator[tuple[int, int]]:
    """Runs of texts of about _PIECE characters."""
    at = 0
    while at < len(texts):
        end, size = at, 0
        while end < len(texts) and (size < _PIECE or end == at):
            size += len(texts[end])
            end += 1
        yield at, end
        at = end


@dataclass(frozen=True)
class Model:
    languages: tuple[str, ...]
    table: np.ndarray  # scores of every bucket, with an empty row at the end
    temperature: float
    limit: float

    def scores(self, texts: list[str]) -> np.ndarray:
        """Probability of every language for each text."""
        out = np.zeros((len(texts), len(self.languages)))
        for a, b in _pieces(texts):
            bucket, starts = buckets_of(texts[a:b])
            for k in range(len(self.languages)):
                column = np.ascontiguousarray(self.table[:, k])
                total = np.add.reduceat(sum(column[bucket[:, n]] for n in range(len(GRAMS))), starts)
                out[a:b, k] = total
            count = np.add.reduceat((bucket < BUCKETS).sum(axis=1), starts)
            out[a:b] /= count[:, None]
        return softmax(out / self.temperature)


def softmax(z: np.ndarray) -> np.ndarray:
    e = np.exp(z - z.max(axis=1, keepdims=True))
    return e / e.sum(axis=1, keepdims=True)


def _counts(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Bucket counts of each text, at most BUCKETS numbers however long it is."""
    for batch in batches:
        out = []
        for lang, h, text in zip(batch["lang"], batch["hash"], batch["text"]):
            bucket, _ = buckets_of([text])
            n = np.bincount(bucket.ravel(), minlength=BUCKETS + 1)[:BUCKETS].astype(np.float32)
            at = np.flatnonzero(n)
            out.append((lang, h, at.astype(np.int32).tobytes(), (n[at] / n.sum()).tobytes()))
        yield pd.DataFrame(out, columns=["lang", "hash", "at", "share"])


def train(learn: DataFrame) -> Model | None:
    """``learn``: id, text and lang, the rows to learn from."""
    known = learn.filter(F.col("lang").isNotNull() & has_letter("text")).withColumn("hash", F.xxhash64("text"))
    different = known.groupBy("lang", "hash").agg(F.min("id").alias("id"))
    # First of a 64th each, so that a language with most of the texts is not ranked in one task.
    few = first_rows(different.withColumn("_part", F.pmod("hash", F.lit(64))), ["lang", "_part"], ["hash"], PER_LANGUAGE)
    chosen = store(first_rows(few.drop("_part"), ["lang"], ["hash"], PER_LANGUAGE), "sample")
    if chosen.rows > MOST_SAMPLED:
        each = max(1, MOST_SAMPLED // chosen.df.select("lang").distinct().count())
        chosen = store(first_rows(chosen.df, ["lang"], ["hash"], each), "sample")
    few = F.broadcast(chosen.df.toDF("_lang", "_hash", "_id"))
    cond = (F.col("lang") == F.col("_lang")) & (F.col("hash") == F.col("_hash")) & F.col("id").eqNullSafe(F.col("_id"))
    texts = known.join(few, cond).select("lang", "hash", "text")
    found = texts.mapInPandas(_counts, "lang string, hash bigint, at binary, share binary").dropDuplicates(["lang", "hash"])
    sample = sorted(found.collect(), key=lambda r: (r["hash"], r["lang"]))
    if not sample:
        return None
    languages = tuple(sorted({r["lang"] for r in sample}))
    x = Sparse([np.frombuffer(r["at"], np.int32) for r in sample], [np.frombuffer(r["share"], np.float32) for r in sample])
    number = {lang: k for k, lang in enumerate(languages)}
    y = np.array([number[r["lang"]] for r in sample])
    back = np.arange(len(sample)) % 5 == 4 if len(sample) >= 20 else np.zeros(len(sample), bool)
    scores = _descend(x, np.flatnonzero(~back), y, len(languages))
    checked = np.flatnonzero(back if back.any() else ~back)
    z = np.concatenate([x.rows(checked[a : a + 256]) @ scores for a in range(0, len(checked), 256)])
    temperature, limit = _calibrated(z, y[checked])
    return Model(languages, np.vstack([scores, np.zeros((1, len(languages)))]).astype(np.float32), temperature, limit)


@dataclass(frozen=True)
class Sparse:
    """Bucket shares of the sample: only a batch of rows is ever written out."""

    at: list[np.ndarray]
    share: list[np.ndarray]

    def rows(self, which: np.ndarray) -> np.ndarray:
        out = np.zeros((len(which), BUCKETS), np.float32)
        for k, i in enumerate(which):
            out[k, self.at[i]] = self.share[i]
        return out


def _descend(x: Sparse, learn: np.ndarray, y: np.ndarray, classes: int) -> np.ndarray:
    """Embeddings times output weights after stochastic gradient descent on the rows ``learn``."""
    rng = np.random.Generator(np.random.PCG64(11))
    embed = rng.normal(0, 1, (BUCKETS, DIMENSIONS)).astype(np.float32)
    out = np.zeros((DIMENSIONS, classes), np.float32)
    for epoch in range(EPOCHS):
        rate = RATE * (1 - epoch / EPOCHS)
        order = learn[rng.permutation(len(learn))]
        for at in range(0, len(order), BATCH):
            rows = order[at : at + BATCH]
            part = x.rows(rows)
            hidden = part @ embed
            error = softmax(hidden @ out)
            error[np.arange(len(rows)), y[rows]] -= 1
            error /= len(rows)
            back = error @ out.T
            out -= rate * 10 * (hidden.T @ error)
            # Buckets are averaged over many subwords, so their steps are scaled up.
            embed -= rate * 100 * (part.T @ back)
    return embed @ out


def _calibrated(z: np.ndarray, y: np.ndarray) -> tuple[float, float]:
    """The temperature with the least log loss, and the least score that is precise enough."""
    choices = np.geomspace(0.05, 20, 121)
    loss = [-np.log(np.maximum(softmax(z / t)[np.arange(len(y)), y], 1e-12)).mean() for t in choices]
    t = float(choices[int(np.argmin(loss))])
    p = softmax(z / t)
    top, right = p.max(axis=1), p.argmax(axis=1) == y
    order = np.argsort(-top, kind="stable")
    precise = np.flatnonzero(np.cumsum(right[order]) / np.arange(1, len(y) + 1) >= PRECISION)
    return t, float(top[order][precise[-1]]) if len(precise) else 1.0


def has_letter(text: str) -> Column:
    return F.coalesce(F.col(text).rlike(r"\p{L}"), F.lit(False))


def predict(docs: DataFrame, model: Model | None) -> DataFrame:
    """``docs`` (id, text and small columns) with lang_pred, score and accepted instead of the text."""
    rest = [f for f in docs.schema.fields if f.name != "text"]

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            readable = batch["_letters"].to_numpy(bool) if model else np.zeros(len(batch), bool)
            lang = np.full(len(batch), "und", object)
            score = np.zeros(len(batch))
            if readable.any():
                p = model.scores(batch["text"][readable].tolist())
                lang[readable] = np.array(model.languages, object)[p.argmax(axis=1)]
                score[readable] = p.max(axis=1)
            out = batch[[f.name for f in rest]].copy()
            out["lang_pred"], out["score"] = lang, score
            out["accepted"] = readable & (score >= (model.limit if model else 2))
            yield out

    schema = ", ".join([*(f"`{f.name}` {f.dataType.simpleString()}" for f in rest), "lang_pred string, score double, accepted boolean"])
    return docs.withColumn("_letters", has_letter("text")).mapInPandas(run, schema)


@query()
def op3_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    fold = F.crc32(F.coalesce(F.col("doc_id").cast("string"), F.lit("")).cast("binary")) % 3
    docs = table(spark, sf_dir, "documents").select(F.col("doc_id").cast("string").alias("id"), "text", "lang", (fold == 1).alias("held_out"))
    model = train(docs.filter(~F.col("held_out")).select("id", "text", "lang"))
    found = predict(docs.select("id", "held_out", "text"), model)
    return found.withColumn("id", F.col("id").cast("long")).withColumnRenamed("id", "doc_id")
