"""Language-model scores by deleted interpolation.

The model mixes three estimates of a token after the one before it: its share
after that token (bigram counts), its share of all tokens, and one over the
vocabulary. How they are mixed depends on how often the token before was seen:
contexts fall into buckets by the logarithm of their count, and each bucket
has its own weights. The weights are learned by expectation-maximisation on
deleted counts, where every training token is predicted from counts without
itself, so all the training data are held out in turn.

Counts are exact and cover the whole corpus. The corpus is cut into blocks of
at most ``BLOCK_TOKENS`` tokens, whatever the length of its texts: a long text
goes over several blocks, and its parts are added up at the end. A block asks
for each of its distinct n-grams once, by a 64-bit hash, and names how often it
has it in training; requests are dealt out by hash range, summed there, and
answered with the totals. So what travels is the distinct n-grams of each
block, and no table of counts is ever held whole. The texts are read twice, to
ask and to be written as numbers of the n-grams in their block, which then meet
the totals. Both times the same files are cut alike; other inputs are written first.

Tokens are the words with A to Z in lower case, then one end.

Defined cases: null counts as empty, which is one token, the end. Without
training rows every estimate but one over the vocabulary is 0. A null id
counts as the empty text when folds are dealt. Repeated rows are documents of
their own. An empty table gives no rows. Other columns are left out.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm.common import partitions, pieces, table, whole_groups
from tidemark.llm.registry import query
from tidemark.llm.tokens import mix, word_hashes
from tidemark.session import materialise

BLOCK_TOKENS = 1 << 20
PIECE = 3 << 20  # characters of short texts in a block
ROUNDS = 200
PER_OCTAVE = 4  # cells of probabilities the weights are learned from
LEAST_WEIGHT = 1e-6
# Of pair, token and vocabulary, for buckets without training tokens. After a context never seen no pair is known.
_DEFAULT, _UNSEEN = (0.4, 0.4, 0.2), (0.0, 2 / 3, 1 / 3)
_START, _END = (mix(np.array([n], np.uint64), 0xC0FFEE)[0] for n in (1, 2))
_ASK = "kind int, part int, block string, keys binary, counts binary"  # kind 0: tokens, 1: pairs
_BLOCK = "block string, docs binary, tokens binary, before binary, pairs binary"
_ANSWER = "kind int, part int, block string, totals binary, tokens bigint, types bigint"
_COUNTED = "docs binary, tokens binary, contexts binary, pairs binary"
_PART = "id bigint, no_id boolean, learn boolean, row bigint, n_tokens bigint, n_known bigint, base_score double, score double"


def _packed(numbers: np.ndarray) -> bytes:
    return zlib.compress(numbers.astype(np.int64).tobytes(), 1)


def _unpacked(data: bytes) -> np.ndarray:
    return np.frombuffer(zlib.decompress(data), np.int64)


def _frame(rows: list[tuple], schema: str) -> pd.DataFrame:
    return pd.DataFrame(rows, columns=[c.split()[0] for c in schema.split(", ")])


def _ngrams(texts) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Keys of the tokens, of what stands before each, of both together, and where each text starts and ends."""
    h, bounds = word_hashes(texts, lower=True)
    n = len(bounds) - 1
    places = bounds + np.arange(n + 1)
    token = np.empty(len(h) + n, np.uint64)
    inside = np.ones(len(token), bool)
    inside[places[1:] - 1] = False
    token[inside], token[~inside] = h, _END
    before = np.empty_like(token)
    before[1:] = token[:-1]
    before[places[:-1]] = _START
    return mix(token, 1), mix(before, 1), mix(mix(before, 2) + token, 3), places


_FIELDS = 5  # of the part of a text in a block: row, id, no_id, learn, number of tokens
_START_KEY = mix(np.array([_START], np.uint64), 1)[0]


def _blocks(batches: Iterator[pd.DataFrame], size: int) -> Iterator[tuple[str, np.ndarray, np.ndarray, np.ndarray, np.ndarray]]:
    """Blocks with the parts of texts in them, their tokens, what stands before each part, and their pairs."""
    for rows in (p for b in batches for p in pieces(b, chars=PIECE)):
        token, before, pair, places = _ngrams(rows["text"])
        own = rows[["row", "id", "no_id", "learn"]].to_numpy(np.int64)
        for a in range(0, len(token), size):
            b = min(a + size, len(token))
            d, e = np.searchsorted(places, a, "right") - 1, np.searchsorted(places, b)
            limits = np.clip(places[d : e + 1], a, b)
            docs = np.column_stack([own[d:e], np.diff(limits)])
            yield f"{own[0, 0]}:{a}", docs, token[a:b], before[limits[:-1]], pair[a:b]


def _tokens_of(token: np.ndarray, before: np.ndarray) -> np.ndarray:
    """All tokens a block needs: its own, those before its parts, the start."""
    return np.concatenate([token, before, _START_KEY[None]])


def _bounds(keys: np.ndarray, parts: int) -> np.ndarray:
    """Where the hash range of each part starts in sorted keys, and the end."""
    limits = np.array([(p << 64) // parts for p in range(parts)], np.uint64)
    return np.append(np.searchsorted(keys, limits), len(keys))


def _asked(parts: int, size: int):
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for block, docs, token, before, pair in _blocks(batches, size):
            learn = np.repeat(docs[:, 3], docs[:, 4]).astype(bool)
            out = []
            for kind, keys in ((0, _tokens_of(token, before)), (1, pair)):
                distinct, which = np.unique(keys, return_inverse=True)
                n = np.bincount(which[: len(token)][learn], minlength=len(distinct))
                if kind == 0:  # the start is a context, seen once per text
                    n[which[-1]] += int((docs[:, 3].astype(bool) & (before == _START_KEY)).sum())
                cut = _bounds(distinct, parts)
                out += [(kind, p, block, distinct[a:b].tobytes(), _packed(n[a:b])) for p, (a, b) in enumerate(zip(cut, cut[1:])) if b > a]
            yield _frame(out, _ASK)

    return run


def _numbered(size: int):
    """Blocks with the numbers of their n-grams among the sorted ones."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for block, docs, token, before, pair in _blocks(batches, size):
            which = np.unique(_tokens_of(token, before), return_inverse=True)[1]
            parts = (docs.ravel(), which[: len(token)], which[len(token) :], np.unique(pair, return_inverse=True)[1])
            yield _frame([(block, *map(_packed, parts))], _BLOCK)

    return run


def _answered(rows: pd.DataFrame) -> pd.DataFrame:
    """The totals of one hash range for each block, in the order of the block's sorted keys."""
    keys = [np.frombuffer(k, np.uint64) for k in rows["keys"]]
    distinct, which = np.unique(np.concatenate(keys), return_inverse=True)
    total = np.bincount(which, np.concatenate([_unpacked(c) for c in rows["counts"]]).astype(np.float64))
    total = np.rint(total).astype(np.int64)
    kind, part = int(rows["kind"].iloc[0]), int(rows["part"].iloc[0])
    words = total[distinct != _START_KEY] if kind == 0 else total[:0]
    out = []
    at = 0
    for block, k in zip(rows["block"], keys):
        sums = (0, 0) if out else (int(words.sum()), int((words > 0).sum()))
        out.append((kind, part, block, _packed(total[which[at : at + len(k)]]), *sums))
        at += len(k)
    return pd.DataFrame(out, columns=["kind", "part", "block", "totals", "tokens", "types"])


def _counted(rows: pd.DataFrame, answers: pd.DataFrame) -> pd.DataFrame:
    """The parts of texts in a block with the totals of their n-grams."""
    if not len(rows):
        return _frame([], _COUNTED)
    answers = answers.sort_values("part")
    kind = answers["kind"].to_numpy()
    c1, c2 = (np.concatenate([_unpacked(t) for t in answers["totals"][kind == k]]) for k in (0, 1))
    block = rows.iloc[0]
    tokens, before, pairs = (_unpacked(block[c]) for c in ("tokens", "before", "pairs"))
    if len(rows) > 1 or max(tokens.max(), before.max()) + 1 != len(c1) or pairs.max() + 1 != len(c2):
        raise RuntimeError("the documents were not the same when they were read again")
    return _frame([(block["docs"], _packed(c1[tokens]), _packed(c1[before[:-1]]), _packed(c2[pairs]))], _COUNTED)


def _triples(block) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Parts of texts, and the counts of tokens, of their contexts and of pairs."""
    docs = _unpacked(block.docs).reshape(-1, _FIELDS)
    c1, c2 = _unpacked(block.tokens), _unpacked(block.pairs)
    context = np.empty_like(c1)
    context[1:] = c1[:-1]
    context[np.cumsum(docs[:, 4]) - docs[:, 4]] = _unpacked(block.contexts)
    return docs, c1, context, c2


def bucket_of(context: np.ndarray) -> np.ndarray:
    """0 for a context never seen, then one bucket for each doubling."""
    return np.frexp(np.maximum(context, 0).astype(np.float64))[1]


_NONE = -10_000


def _deleted(tokens: int):
    """How often each (bucket, pair probability, token probability) occurs with the token itself taken out.

    Probabilities fall into cells of a quarter of an octave; a cell has their sums besides.
    """

    def log(share: np.ndarray) -> np.ndarray:
        seen = share > 0
        return np.where(seen, np.round(np.log2(np.where(seen, share, 1)) * PER_OCTAVE), _NONE).astype(np.int64)

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for block in (x for b in batches for x in b.itertuples()):
            docs, c1, context, c2 = _triples(block)
            learn = np.repeat(docs[:, 3], docs[:, 4]).astype(bool)
            c1, context, c2 = c1[learn], context[learn] - 1, c2[learn]
            p2 = np.where(context > 0, (c2 - 1) / np.maximum(context, 1), 0)
            p1 = (c1 - 1) / max(tokens - 1, 1)
            cell = (bucket_of(context).astype(np.int64) << 40) + ((log(p2) - _NONE) << 20) + (log(p1) - _NONE)
            cells, which = np.unique(cell, return_inverse=True)
            yield pd.DataFrame({"cell": cells, "n": np.bincount(which, minlength=len(cells)), "p2": np.bincount(which, p2, len(cells)), "p1": np.bincount(which, p1, len(cells))})

    return run


def learn_weights(cells: list[tuple[int, int, float, float]], types: int) -> np.ndarray:
    """Weights of pair, token and vocabulary for each bucket, by expectation-maximisation on the means of cells."""
    weights = np.tile(_DEFAULT, (65, 1))
    weights[0] = _UNSEEN
    code, n, p2, p1 = (np.array(x) for x in (zip(*cells) if cells else ((), (), (), ())))
    bucket = code.astype(np.int64) >> 40
    p = np.stack([p2 / np.maximum(n, 1), p1 / np.maximum(n, 1), np.full(len(n), 1 / (types + 1))], axis=1)
    for b in np.unique(bucket):
        mine, count = p[bucket == b], n[bucket == b][:, None]
        w = weights[b]
        for _ in range(ROUNDS):
            share = mine * w
            share /= share.sum(axis=1, keepdims=True)
            new = (share * count).sum(axis=0) / count.sum()
            new = np.maximum(new, LEAST_WEIGHT)
            new /= new.sum()
            done = np.abs(new - w).max() < 1e-9
            w = new
            if done:
                break
        weights[b] = w
    return weights


def _scored(weights: np.ndarray, tokens: int, types: int):
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for block in (x for b in batches for x in b.itertuples()):
            docs, c1, context, c2 = _triples(block)
            first = np.cumsum(docs[:, 4]) - docs[:, 4]
            w = weights[bucket_of(context)]
            p = w[:, 0] * (c2 / np.maximum(context, 1)) + w[:, 1] * (c1 / max(tokens, 1)) + w[:, 2] / (types + 1)
            yield pd.DataFrame(
                {
                    "id": docs[:, 1], "no_id": docs[:, 2].astype(bool), "learn": docs[:, 3].astype(bool), "row": docs[:, 0], "n_tokens": docs[:, 4],
                    "n_known": np.add.reduceat((c1 > 0).astype(np.int64), first),
                    "base_score": np.add.reduceat(np.log10((c1 + 0.5) / (tokens + 0.5 * (types + 1))), first),
                    "score": np.add.reduceat(np.log10(p), first),
                }
            )

    return run


def _steady(docs: DataFrame) -> DataFrame:
    """Rows that come in the same order and tasks whenever they are read: those of files."""
    try:
        docs.select("_metadata.row_index")
        return docs
    except AnalysisException:
        return materialise(docs, "documents")


def score(docs: DataFrame, id: str = "doc_id", text: str = "text", learn: str = "learn", block_tokens: int = BLOCK_TOKENS) -> DataFrame:
    """id, learn, n_tokens, n_known, train_tokens, base_score and score (log10) of every row; ``learn`` marks training rows."""
    spark = docs.sparkSession
    parts = 4 * partitions(spark)
    number = F.col(f"`{id}`").cast("long")
    rows = _steady(docs.select(f"`{id}`", f"`{text}`", f"`{learn}`")).select(
        F.monotonically_increasing_id().alias("row"), F.coalesce(number, F.lit(0).cast("long")).alias("id"), number.isNull().alias("no_id"),
        F.coalesce(F.col(f"`{learn}`"), F.lit(False)).alias("learn"), F.col(f"`{text}`").alias("text"),
    )
    answers = materialise(
        whole_groups(rows.mapInPandas(_asked(parts, block_tokens), _ASK), ["kind", "part"], lambda x, first: pd.concat(
            [_answered(x.iloc[a:b]) for a, b in zip(first, [*first[1:], len(x)])], ignore_index=True), _ANSWER),
        "answers",
    )
    sums = answers.agg(F.sum("tokens").alias("n"), F.sum("types").alias("v")).first()
    tokens, types = int(sums["n"] or 0), int(sums["v"] or 0)
    both = rows.mapInPandas(_numbered(block_tokens), _BLOCK).groupBy("block").cogroup(answers.select("block", "kind", "part", "totals").groupBy("block"))
    counted = materialise(both.applyInPandas(_counted, _COUNTED), "counted")
    deleted = counted.mapInPandas(_deleted(tokens), "cell bigint, n bigint, p2 double, p1 double")
    # Cells are rounded probabilities: as many as there are grid points, however large the corpus.
    cells = deleted.groupBy("cell").agg(*[F.sum(c).alias(c) for c in ("n", "p2", "p1")]).orderBy("cell")
    weights = learn_weights([tuple(r) for r in cells.collect()], types)
    scored = counted.mapInPandas(_scored(weights, tokens, types), _PART)
    # The parts of a text, nearly always one, are added up.
    summed = scored.groupBy("row", "id", "no_id", "learn").agg(*[F.sum(c).alias(c) for c in ("n_tokens", "n_known", "base_score", "score")])
    return summed.select(
        F.when(~F.col("no_id"), F.col("id")).alias("id"), "learn", "n_tokens", "n_known",
        F.lit(tokens).cast("long").alias("train_tokens"), "base_score", "score",
    )


@query()
def op10_lm_score(spark: SparkSession, sf_dir: str) -> DataFrame:
    fold = F.crc32(F.coalesce(F.col("doc_id").cast("string"), F.lit("")).cast("binary")) % 5
    found = score(table(spark, sf_dir, "documents").select("doc_id", "text").withColumn("learn", fold != 1))
    return found.select(
        F.col("id").alias("doc_id"), (~F.col("learn")).alias("held_out"), "n_tokens", "n_known", "train_tokens", "base_score", "score"
    )
