"""Ranked lexical search over posting lists that are blocked by document similarity.

Documents are dealt into chunks as they are read, and every chunk is an index
of its own, so no posting list is ever gathered from the whole corpus. In a
chunk, the posting list of each term is clustered: documents have a sketch (a
random projection of their weighted terms), a list takes evenly spaced
documents of its own as pivots, and a posting joins the pivot that its document
is most similar to. Clusters, cut at twice ``BLOCK`` postings, are the blocks of
the list. A block stores the coordinatewise maximum of its documents: for each
term the largest impact any of them has.

Terms are ranked from the rarest to the most frequent, and a query walks its
lists in that order. A document is due in the list of its rarest query term;
there the sum of weight times summary over this and all later terms bounds its
whole score. A block is skipped only if that bound is below the score of the
k-th best document so far, and the walk ends when the weights that are left
cannot reach it. All sums are integers, so bounds are exact and the result is
that of scoring every document. Documents of the other blocks are scored in
full from the chunk's forward rows. A first pass over the two rarest lists of
each query sets a score to reach that holds for all chunks.

The index holds the terms of a query table, and the summaries the pairs of
terms that meet in a query, for each term those with the ``WIDTH`` rarest later
ones; terms beyond count with the largest impact there can be, so that long
queries loosen the bound but do not swell the index. Queries with more than ``PAIRS`` (item, term)
pairs are searched in several slices, so what a task holds of them is bounded.

Every task keeps the k best documents of an item over all its chunks; they meet
by a window over (item, salt) and one over the item. Terms are compared by
64-bit hashes.

Defined cases: null and empty texts have no terms: as a document they never
match, as an item they have no rows. Rows with the same id are documents (items)
of their own. A null document id comes after all others of the same score. A
very long text is a chunk of its own. An empty table of either kind gives no
rows. Other columns are left out.
"""

from __future__ import annotations

import math
import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tidemark.llm.common import joined, pieces, table
from tidemark.llm.registry import query
from tidemark.llm.tokens import TERMS, word_hashes
from tidemark.session import materialise, store

K = 50
PAIRS = 1 << 20  # (item, term) pairs that are searched at a time
CHUNK = 1 << 23  # characters of a chunk
BLOCK = 32  # postings of a block on average
WIDTH = 512  # terms in the summaries of a list
SKETCH = 16
SEEDS = 2  # lists of a query that set the score to reach
SALTS = 64
MOST_IMPACT = 1_000_000  # no impact reaches it
_FORWARD = "ids binary, no_ids binary, lengths binary, ptr binary, ords binary, tf binary, with_terms bigint, terms bigint"
_INDEX = (
    "ids binary, no_ids binary, ptr binary, term binary, impact binary, lists binary, list_ptr binary, limits binary, members binary, "
    "block_ptr binary, summary_ptr binary, summary_term binary, summary_impact binary"
)
_FOUND = "item int, score bigint, id bigint, no_id boolean"


def _names(schema: str) -> list[str]:
    return [c.split()[0] for c in schema.split(", ")]


def _pack(x: np.ndarray, kind: type = np.int32) -> bytes:
    return zlib.compress(x.astype(kind).tobytes(), 1)


def _unpack(data: bytes, kind: type = np.int32) -> np.ndarray:
    return np.frombuffer(zlib.decompress(data), kind)


def _joined(parts: list[np.ndarray], kind: type = np.int64) -> np.ndarray:
    return np.concatenate([*parts, np.zeros(0, kind)])


def _ranges(starts: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """The places starts[i] to starts[i] + sizes[i] - 1 of all i, one after the other."""
    ends = np.cumsum(sizes)
    return np.arange(ends[-1] if len(ends) else 0) + np.repeat(starts - (ends - sizes), sizes)


def _sums(values: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """Sums of runs of the given sizes, empty ones too."""
    total = np.concatenate([np.zeros(1, np.int64), np.cumsum(values)])
    ends = np.cumsum(sizes)
    return total[ends] - total[ends - sizes]


# -- reading -------------------------------------------------------------------


def _items(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for rows in (p for b in batches for p in pieces(b)):
        h, bounds = word_hashes(rows["text"], lower=True, made_of=TERMS)
        terms = [np.unique(h[a:b]) for a, b in zip(bounds, bounds[1:])]
        yield pd.DataFrame({"row": rows["row"], "terms": [t.tobytes() for t in terms], "n": [len(t) for t in terms]})


def _forward(vocabulary: np.ndarray):
    """Chunks of documents with their terms as numbers in the sorted vocabulary."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for rows in (p for b in batches for p in pieces(b, chars=CHUNK)):
            h, bounds = word_hashes(rows["text"], lower=True, made_of=TERMS)
            at = np.minimum(np.searchsorted(vocabulary, h), len(vocabulary) - 1)
            known = vocabulary[at] == h
            n = np.diff(bounds)
            doc = np.repeat(np.arange(len(rows)), n)[known]
            keys, tf = np.unique(doc * len(vocabulary) + at[known], return_counts=True)
            ptr = np.searchsorted(keys, np.arange(len(rows) + 1) * len(vocabulary))
            some = np.flatnonzero(np.diff(ptr))  # other documents only count
            chunk = (
                _pack(rows["id"].to_numpy()[some], np.int64), _pack(rows["no_id"].to_numpy()[some], np.bool_), _pack(n[some]),
                _pack(np.append(ptr[some], ptr[-1])), _pack(keys % len(vocabulary)), _pack(tf), int((n > 0).sum()), int(n.sum()),
            )
            yield pd.DataFrame([chunk], columns=_names(_FORWARD))

    return run


def _frequencies(size: int):
    """In how many documents of a task each term is."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        n = np.zeros(size, np.int64)
        for batch in batches:
            for ords in batch["ords"]:
                n += np.bincount(_unpack(ords), minlength=size)
        at = np.flatnonzero(n)
        yield pd.DataFrame({"ord": at, "df": n[at]})

    return run


# -- building ------------------------------------------------------------------


@dataclass(frozen=True)
class Terms:
    """What every task needs of the terms that are asked for, which are ranked from the rarest to the most frequent."""

    rank: np.ndarray  # of each number in the vocabulary, -1 if its weight is 0
    weight: np.ndarray  # by rank
    items: list[np.ndarray]  # the ranks of each item's terms, ascending
    documents: int
    length: int


def _having(terms: Terms) -> tuple[np.ndarray, np.ndarray]:
    """The items that have each rank, one rank after the other, and where each rank starts."""
    rank = _joined(terms.items)
    item = np.repeat(np.arange(len(terms.items)), [len(t) for t in terms.items])
    order = np.argsort(rank, kind="stable")
    return item[order], np.searchsorted(rank[order], np.arange(len(terms.weight) + 1))


def _blocks(docs: np.ndarray, sketch: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The order of a list's postings and the block of each: clusters of similar documents."""
    if len(docs) <= BLOCK:
        return np.arange(len(docs)), np.zeros(len(docs), np.int64)
    pivots = np.linspace(0, len(docs) - 1, -(-len(docs) // BLOCK)).astype(np.int64)
    near = np.argmax(sketch[docs] @ sketch[docs[pivots]].T, axis=1)
    order = np.argsort(near, kind="stable")
    near = near[order]
    inside = np.arange(len(near)) - np.searchsorted(near, near)
    new = np.ones(len(near), bool)
    new[1:] = (near[1:] != near[:-1]) | (inside[1:] % (2 * BLOCK) == 0)
    return order, np.cumsum(new) - 1


_IMPACT_BITS, _TERM_BITS = np.uint64(20), np.uint64(21)


def _largest(cells: np.ndarray) -> np.ndarray:
    """Of cells (block, term, impact) packed into one number each, the largest of every (block, term)."""
    cells = np.sort(cells)
    key = cells >> _IMPACT_BITS
    return cells[np.append(key[1:] != key[:-1], True)[: len(cells)]]


def _indexed(terms: Terms):
    having, having_ptr = _having(terms)
    size = len(terms.weight)
    project = np.random.Generator(np.random.PCG64(11)).standard_normal((size, SKETCH))

    def partners(t: int, mask: np.ndarray) -> int:
        """Mark the terms from this one on that are in an item with it, and return the last one that is in summaries."""
        mine = having[having_ptr[t] : having_ptr[t + 1]]
        every = sum(len(terms.items[i]) for i in mine) >= size
        mask[:] = every
        for i in () if every else mine:
            mask[terms.items[i]] = True
        return t + int(np.flatnonzero(mask[t:])[:WIDTH][-1])

    def chunk(row) -> tuple:
        lengths, ptr = _unpack(row.lengths).astype(np.int64), _unpack(row.ptr).astype(np.int64)
        rank, tf = terms.rank[_unpack(row.ords)], _unpack(row.tf).astype(np.int64)
        doc = np.repeat(np.arange(len(lengths)), np.diff(ptr))
        m = 100 - 50 + 50 * lengths * terms.documents // max(terms.length, 1)
        impact = 1000 * MOST_IMPACT * tf // (1000 * tf + 20 * m[doc])
        used = rank >= 0
        order = np.lexsort([rank[used], doc[used]])
        doc, rank, impact = doc[used][order], rank[used][order], impact[used][order]
        ptr = np.searchsorted(doc, np.arange(len(lengths) + 1))
        place_of = doc * size + rank
        cell = (rank.astype(np.uint64) << _IMPACT_BITS) | impact.astype(np.uint64)
        sketch = np.stack([np.bincount(doc, project[rank, k] * terms.weight[rank] * impact, len(lengths)) for k in range(SKETCH)], axis=1)
        sketch = (sketch / np.maximum(np.linalg.norm(sketch, axis=1, keepdims=True), 1e-9)).astype(np.float32)

        posting = np.argsort(rank, kind="stable")  # list by list, as places in the forward rows
        lists, first = np.unique(rank[posting], return_index=True)
        members, limits, list_sizes, block_sizes, summary_sizes, summaries = [], [], [], [], [], []
        mask = np.zeros(size, bool)
        for t, a, b in zip(lists, first, [*first[1:], len(posting)]):
            place = posting[a:b]
            order, block = _blocks(doc[place], sketch)
            place, n = place[order], int(block[-1]) + 1
            limits.append(partners(t, mask))
            # The part of each document's row from this term to the last one.
            sizes = np.searchsorted(place_of, doc[place] * size + limits[-1], "right") - place
            step = max(1, (1 << 20) // max(1, int(sizes.mean())))
            cells = []
            for s in range(0, len(place), step):
                many = sizes[s : s + step]
                at = _ranges(place[s : s + step], many)
                of = np.repeat(block[s : s + step].astype(np.uint64) << (_IMPACT_BITS + _TERM_BITS), many)
                keep = mask[rank[at]]
                cells.append(_largest(of[keep] | cell[at[keep]]))
            cells = cells[0] if len(cells) == 1 else _largest(np.concatenate(cells))
            members.append(doc[place])
            list_sizes.append(n)
            block_sizes.append(np.bincount(block, minlength=n))
            summary_sizes.append(np.bincount((cells >> (_IMPACT_BITS + _TERM_BITS)).astype(np.int64), minlength=n))
            summaries.append(cells & ((np.uint64(1) << (_IMPACT_BITS + _TERM_BITS)) - np.uint64(1)))
        starts = lambda sizes: np.append(0, np.cumsum(sizes))
        summary = _joined(summaries, np.uint64)
        return (
            row.ids, row.no_ids, _pack(ptr), _pack(rank), _pack(impact), _pack(lists), _pack(starts(list_sizes)), _pack(np.array(limits)), _pack(_joined(members)),
            _pack(starts(_joined(block_sizes))), _pack(starts(_joined(summary_sizes))),
            _pack(summary >> _IMPACT_BITS), _pack(summary & ((np.uint64(1) << _IMPACT_BITS) - np.uint64(1))),
        )

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for row in (x for b in batches for x in b.itertuples()):
            yield pd.DataFrame([chunk(row)], columns=_names(_INDEX))

    return run


# -- searching -----------------------------------------------------------------


class Chunk:
    """The index of a chunk, unpacked."""

    def __init__(self, row) -> None:
        self.ids, self.no_ids = _unpack(row.ids, np.int64), _unpack(row.no_ids, np.bool_)
        self.ptr, self.lists, self.list_ptr, self.limits, self.members, self.block_ptr, self.summary_ptr = (
            _unpack(x).astype(np.int64) for x in (row.ptr, row.lists, row.list_ptr, row.limits, row.members, row.block_ptr, row.summary_ptr)
        )
        self.term, self.summary_term = _unpack(row.term), _unpack(row.summary_term)
        self.impact, self.summary_impact = (_unpack(x).astype(np.int64) for x in (row.impact, row.summary_impact))

    def scores(self, docs: np.ndarray, weight: np.ndarray) -> np.ndarray:
        sizes = self.ptr[docs + 1] - self.ptr[docs]
        at = _ranges(self.ptr[docs], sizes)
        return _sums(weight[self.term[at]] * self.impact[at], sizes)

    def bounds(self, a: int, b: int, weight: np.ndarray) -> np.ndarray:
        """Of blocks a to b - 1, the most that a document due in them can score by the terms of their summaries."""
        lo, hi = self.summary_ptr[a], self.summary_ptr[b]
        return _sums(weight[self.summary_term[lo:hi]] * self.summary_impact[lo:hi], np.diff(self.summary_ptr[a : b + 1]))


class Best:
    """The k best documents of an item."""

    def __init__(self, k: int, reach: int) -> None:
        self.k, self.reach = k, reach
        self.score, self.id, self.no_id = np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, bool)

    def add(self, score: np.ndarray, id: np.ndarray, no_id: np.ndarray) -> None:
        use = (score >= self.reach) & (score > 0)
        if not use.any():
            return
        score, id, no_id = (np.concatenate([a, b[use]]) for a, b in ((self.score, score), (self.id, id), (self.no_id, no_id)))
        first = np.lexsort([id, no_id, -score])[: self.k]
        self.score, self.id, self.no_id = score[first], id[first], no_id[first]
        if len(first) == self.k:
            self.reach = max(self.reach, int(self.score[-1]))


def walk(chunk: Chunk, terms: np.ndarray, weight: np.ndarray, best: Best, most_lists: int | None = None) -> tuple[int, int]:
    """Take the documents of a chunk that can be among the best of an item; returns blocks opened and skipped.

    ``weight`` is 0 for all terms but the item's. With ``most_lists`` the walk ends after so many lists.
    """
    at = np.searchsorted(chunk.lists, terms)
    here = at < len(chunk.lists)
    here[here] = chunk.lists[at[here]] == terms[here]
    at = at[here]
    # The most that the terms from each one on can add, of all there are.
    left = np.append(np.cumsum(weight[terms][::-1])[::-1], 0) * MOST_IMPACT
    beyond = left[np.searchsorted(terms, chunk.limits[at], "right")]
    left = left[:-1][here]
    seen = np.zeros(len(chunk.ids), bool)
    opened = skipped = 0
    for n, t in enumerate(at):
        if n == most_lists or left[n] < best.reach:
            break
        a, b = chunk.list_ptr[t], chunk.list_ptr[t + 1]
        bound = chunk.bounds(a, b, weight) + beyond[n]
        order = np.argsort(-bound, kind="stable")
        for s in range(0, len(order), 16):
            blocks = order[s : s + 16]
            blocks = blocks[bound[blocks] >= best.reach]
            if not len(blocks):
                skipped += len(order) - s
                break
            skipped += len(order[s : s + 16]) - len(blocks)
            opened += len(blocks)
            starts = chunk.block_ptr[a + blocks]
            docs = chunk.members[_ranges(starts, chunk.block_ptr[a + blocks + 1] - starts)]
            docs = docs[~seen[docs]]
            seen[docs] = True
            best.add(chunk.scores(docs, weight), chunk.ids[docs], chunk.no_ids[docs])
    return opened, skipped


def _searched(terms: Terms, k: int, reach: list[int] | None):
    """The k best documents of each item among those of a task; without ``reach`` among its rarest lists only."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        best = [Best(k, reach[i] if reach else 0) for i in range(len(terms.items))]
        weight = np.zeros(len(terms.weight), np.int64)
        for row in (x for b in batches for x in b.itertuples()):
            chunk = Chunk(row)
            for mine, found in zip(terms.items, best):
                weight[mine] = terms.weight[mine]
                walk(chunk, mine, weight, found, None if reach else SEEDS)
                weight[mine] = 0
        yield pd.DataFrame(
            {
                "item": np.repeat(np.arange(len(best), dtype=np.int32), [len(b.score) for b in best]),
                "score": _joined([b.score for b in best]), "id": _joined([b.id for b in best]),
                "no_id": _joined([b.no_id for b in best], np.bool_),
            }
        )

    return run


def _top(found: DataFrame, k: int) -> DataFrame:
    """The k best rows of each item with their rank; salted first, as there are few items and many tasks."""
    order = (F.desc("score"), "no_id", "id")
    first = lambda *by: F.row_number().over(Window.partitionBy(*by).orderBy(*order))
    part = found.withColumn("salt", F.pmod(F.xxhash64("id"), F.lit(SALTS)))
    part = part.withColumn("rank", first("item", "salt")).filter(F.col("rank") <= k)
    return part.withColumn("rank", first("item")).filter(F.col("rank") <= k).drop("salt")


@dataclass(frozen=True)
class Index:
    """Chunks of documents with their blocked posting lists, stored, for the terms of a set of items."""

    chunks: DataFrame
    terms: Terms

    @staticmethod
    def build(docs: DataFrame, items: list[np.ndarray], id: str = "doc_id", text: str = "text") -> Index:
        """``items`` holds the sorted hashes of each item's terms."""
        vocabulary = np.unique(_joined(items, np.uint64))
        if not len(vocabulary):
            vocabulary = np.zeros(1, np.uint64)
        number = F.col(f"`{id}`").cast("long")
        rows = docs.select(
            F.coalesce(number, F.lit(0).cast("long")).alias("id"), number.isNull().alias("no_id"), F.col(f"`{text}`").alias("text")
        )
        forward = materialise(rows.mapInPandas(_forward(vocabulary), _FORWARD), "forward")
        size = forward.agg(F.sum("with_terms").alias("documents"), F.sum("terms").alias("length")).first()
        documents, length = int(size["documents"] or 0), int(size["length"] or 0)
        counted = forward.select("ords").mapInPandas(_frequencies(len(vocabulary)), "ord bigint, df bigint")
        df = np.zeros(len(vocabulary), np.int64)
        # As many rows as the items have terms, which is bounded.
        for r in counted.groupBy("ord").agg(F.sum("df").alias("df")).collect():
            df[r["ord"]] = r["df"]
        weight = np.array([math.floor(1000 * math.log((2 * documents + 2) / (2 * n + 1))) if n else 0 for n in df.tolist()], np.int64)
        order = np.lexsort([np.arange(len(df)), df])
        order = order[weight[order] > 0]
        rank = np.full(len(df), -1, np.int64)
        rank[order] = np.arange(len(order))
        ranked = [np.sort(r[r >= 0]) for r in (rank[np.searchsorted(vocabulary, i)] for i in items)]
        terms = Terms(rank, weight[order], ranked, documents, length)
        return Index(materialise(forward.mapInPandas(_indexed(terms), _INDEX), "blocks"), terms)

    def search(self, k: int = K) -> DataFrame:
        """item (its place in ``items``), rank, id, no_id, score of the k best documents of each item."""
        seeds = _top(self.chunks.mapInPandas(_searched(self.terms, k, None), _FOUND), k).filter(F.col("rank") == k)
        reach = [0] * len(self.terms.items)
        for r in seeds.select("item", "score").collect():  # one row per item of the slice
            reach[r["item"]] = r["score"]
        return _top(self.chunks.mapInPandas(_searched(self.terms, k, reach), _FOUND), k)


def search(
    docs: DataFrame, items: DataFrame, k: int = K, id: str = "doc_id", text: str = "text", item: str = "item_id", item_text: str = "text"
) -> DataFrame:
    """item, rank, id, score: the k best documents of every item."""
    spark = docs.sparkSession
    named = items.select(F.monotonically_increasing_id().alias("row"), F.col(f"`{item}`").alias("name"), F.col(f"`{item_text}`").alias("text"))
    asked = materialise(named, "items")
    parsed = materialise(asked.select("row", "text").mapInPandas(_items, "row bigint, terms binary, n bigint"), "item-terms").filter("n > 0")
    slices = max(1, -(-(parsed.agg(F.sum("n")).first()[0] or 0) // PAIRS))
    out = None
    for s in range(slices):
        mine = parsed.filter(F.pmod(F.xxhash64("row"), F.lit(slices)) == s).orderBy("row").collect()
        index = Index.build(docs, [np.frombuffer(r["terms"], np.uint64) for r in mine], id, text)
        rows = spark.createDataFrame([(i, r["row"]) for i, r in enumerate(mine)], "item int, row bigint")
        # One row per item of the slice.
        found = index.search(k).join(F.broadcast(rows), "item").drop("item")
        out = found if out is None else out.unionByName(found)
    names = store(asked.select(F.col("row").alias("_row"), "name"), "names")
    whole = joined(out, names, F.col("row") == F.col("_row"))
    return whole.select(F.col("name").alias("item"), "rank", F.when(~F.col("no_id"), F.col("id")).alias("id"), "score")


@query(
    r"""
WITH t AS (
  SELECT doc_id, unnest(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS term
  FROM documents
),
q AS (
  SELECT DISTINCT item_id, unnest(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS term
  FROM benchmark
),
tf AS (SELECT doc_id, term, count(*) AS tf FROM t GROUP BY ALL),
d AS (SELECT doc_id, sum(tf)::BIGINT AS n FROM tf GROUP BY ALL),
s AS (SELECT count(*) AS docs, sum(n)::BIGINT AS len FROM d),
w AS (
  SELECT term, floor(1000 * ln((2 * docs + 2)::DOUBLE / (2 * count(*) + 1)))::BIGINT AS w
  FROM tf, s GROUP BY term, docs
),
scored AS (
  SELECT item_id, doc_id,
    sum(w * ((1000000000 * tf) // (1000 * tf + 20 * (100 - 50 + (50 * n * docs) // len))))::BIGINT AS score
  FROM q JOIN tf USING (term) JOIN w USING (term) JOIN d USING (doc_id), s
  GROUP BY ALL
),
ranked AS (
  SELECT item_id, (row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id))::INT AS rank, doc_id, score
  FROM scored WHERE score > 0
)
SELECT item_id, rank, doc_id, score FROM ranked WHERE rank <= 50"""
)
def op11_lexical_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = search(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    return found.select(F.col("item").alias("item_id"), "rank", F.col("id").alias("doc_id"), "score")
