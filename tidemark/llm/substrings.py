"""Removal of repeated passages by relative Lempel-Ziv parsing.

The symbols of the parse are windows of ``WINDOW`` words, so every factor is long
enough to be removed. The whole corpus is the reference, in blocks: every window
belongs to its anchor, the run of ``GRAM`` words in it with the smallest hash (the
first of equal ones), and neighbouring windows with the same anchor make a phrase.
Equal passages are cut alike wherever they stand, so all places that
a window could match are in one block: that of its anchor's hash.

A block indexes its windows by hash. Each phrase is factored against it greedily:
from the first window that a document with a smaller id has too, the longest run
of windows is taken that stands in a row in one such document; then the parse goes
on behind it. As all windows of a phrase hold its anchor, two of them that are
the same in another phrase have only the same words between them. So a run is known by its first and
its last window, and a factor is checked at its boundaries alone. Factors become
spans; spans of a document are merged. A window is compared by two
independent 64-bit hashes (anchor and window).

Every piece of a batch first settles the repeats inside itself, so a passage
that fills a third of the corpus sends one phrase per piece to its block. Phrases,
not texts, travel. A task sorts its phrases by anchor and holds a batch and the phrases of one
anchor at a time.

Defined cases: null text has no words; a text shorter than a window keeps all
its words. Rows with the same id are one document to each other: their windows
do not remove each other, and repeated rows keep or lose the same words. A
null id is larger than any other. An empty table gives no rows. Extra columns
are left out of the result of ``spans`` and carried by none.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm.common import joined, pieces, table, whole_groups
from tidemark.llm.registry import query
from tidemark.llm.tokens import mix, window_hashes, word_hashes
from tidemark.session import store

WINDOW = 50
GRAM = 20
NO_ID = (1 << 63) - 1
PIECE = 1 << 23  # characters that are parsed at a time
_PHRASE = "anchor bigint, id bigint, text_key bigint, low int, n int, known boolean, windows binary"
_SPAN = "id bigint, text_key bigint, low int, n int"


def _phrases(texts, window: int, gram: int):
    """Per phrase: row, first window, number of windows, anchor hash, place of the anchor; and all window hashes by word."""
    h, bounds = word_hashes(texts)
    whole = window_hashes(h, window, 101)
    grams = window_hashes(h, gram, 202)
    value, place = grams.copy(), np.arange(len(grams))
    reach, span = 1, window - gram + 1
    while reach < span:  # smallest gram among the next ``span``, the first of equal ones
        step = min(reach, span - reach)
        right = value[step:] < value[: len(value) - step]
        value[: len(right)] = np.where(right, value[step:], value[: len(right)])
        place[: len(right)] = np.where(right, place[step:], place[: len(right)])
        reach += step
    sizes = np.diff(bounds)
    many = np.maximum(sizes - window + 1, 0)
    row = np.repeat(np.arange(len(texts)), many)
    at = np.arange(len(row)) - np.repeat(np.cumsum(many) - many, many) + np.repeat(bounds[:-1], many)
    owner = place[at]
    new = np.ones(len(at), bool)
    new[1:] = (owner[1:] != owner[:-1]) | (row[1:] != row[:-1])
    first = np.flatnonzero(new)
    n = np.diff(np.append(first, len(at)))
    return row[first], at[first] - bounds[row[first]], n, value[at[first]], whole[at], first, owner[first] - at[first]


def _smaller(keys: list[np.ndarray], ids: np.ndarray) -> np.ndarray:
    """Whether an equal key is there with a smaller id."""
    order = np.lexsort([ids, *keys])
    new = np.zeros(len(ids), bool)
    new[:1] = True
    for k in keys:
        k = k[order]
        new[1:] |= k[1:] != k[:-1]
    ids = ids[order]
    out = np.empty(len(ids), bool)
    out[order] = ids > ids[new][np.cumsum(new) - 1]
    return out


def _parsed(window: int, gram: int):
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in (p for b in batches for p in pieces(b, chars=PIECE)):
            row, low, n, anchor, hashes, first, offset = _phrases(batch["text"], window, gram)
            if not len(row):
                continue
            ids, keys = batch["id"].to_numpy()[row], batch["text_key"].to_numpy()[row]
            # A phrase is known by its anchor, where it lies around it, and all its windows.
            total = np.concatenate([[np.uint64(0)], np.cumsum(hashes, dtype=np.uint64)])
            content = total[first + n] - total[first]
            known = _smaller([content, n, offset, anchor], ids)
            # A known phrase is a span already; it goes anywhere, not to the block of what may be a frequent passage.
            anchor = np.where(known, mix(ids.view(np.uint64) + low.astype(np.uint64)), anchor)
            yield pd.DataFrame(
                {
                    "anchor": anchor.view(np.int64), "id": ids, "text_key": keys, "low": low.astype(np.int32), "n": n.astype(np.int32), "known": known,
                    "windows": [None if k else hashes[a : a + m].tobytes() for k, a, m in zip(known, first, n)],
                }
            )

    return run


def _ranges(starts: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """The places starts[i] to starts[i] + sizes[i] - 1 of all i, one after the other."""
    ends = np.cumsum(sizes)
    return np.arange(ends[-1] if len(ends) else 0) + np.repeat(starts - (ends - sizes), sizes)


def factors(anchor: np.ndarray, n: np.ndarray, windows: np.ndarray, ids: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The greedy parse of a block: phrase, first window and number of windows of each factor.

    Phrases have an anchor, ``n`` of the ``windows`` and the id of their document.
    """
    first = np.cumsum(n) - n
    owner = np.repeat(np.arange(len(n)), n)
    key = mix(mix(windows, 5) + anchor[owner], 6)
    found = np.flatnonzero(_smaller([key], ids[owner]))
    new = np.ones(len(found), bool)
    new[1:] = owner[found[1:]] != owner[found[:-1]]
    now = found[new]  # where each phrase is being read
    parsed = []
    while len(now):
        # All places that begin like a factor, and every end that each of them could have.
        starts = np.unique(key[now])
        at = np.minimum(np.searchsorted(starts, key), len(starts) - 1)
        places = np.flatnonzero(starts[at] == key)
        sizes = (first + n)[owner[places]] - places
        ends = _ranges(places, sizes)
        run = np.repeat(np.arange(len(places)), sizes)
        known = _smaller([mix(mix(windows[ends], 7) + key[places][run], 8)], ids[owner[ends]])
        # A run that is known is known up to each of its windows, so their number is its length.
        length = np.bincount(run[known], minlength=len(places))[np.searchsorted(places, now)]
        parsed.append((owner[now], now - first[owner[now]], length))
        behind = np.searchsorted(found, now + length)
        more = behind < len(found)
        more[more] = owner[found[behind[more]]] == owner[now[more]]
        now = found[behind[more]]
    return tuple(np.concatenate([x[i] for x in parsed] + [np.zeros(0, np.int64)]).astype(np.int64) for i in range(3))


def _factored(rows: pd.DataFrame, _: np.ndarray) -> pd.DataFrame:
    """Spans of the factors of whole blocks, and those that are settled already."""
    settled = rows["known"].to_numpy(bool)
    columns = ["id", "text_key", "low", "n"]
    done, rows = rows.loc[settled, columns], rows[~settled]
    if not len(rows):
        return done
    n = rows["n"].to_numpy(np.int64)
    windows, ids, anchor = np.frombuffer(b"".join(rows["windows"]), np.uint64), rows["id"].to_numpy(), rows["anchor"].to_numpy().view(np.uint64)
    # An anchor that stands alone has nothing to be found in.
    _, which, count = np.unique(anchor, return_inverse=True, return_counts=True)
    shared = count[which] > 1
    phrase, start, length = factors(anchor[shared], n[shared], windows[np.repeat(shared, n)], ids[shared])
    picked = rows[shared].iloc[phrase]
    spans = pd.DataFrame({"id": picked["id"].to_numpy(), "text_key": picked["text_key"].to_numpy(), "low": picked["low"].to_numpy() + start, "n": length})
    return pd.concat([done, spans], ignore_index=True).astype({"low": np.int32, "n": np.int32})


def _asked(docs: DataFrame, id: str, text: str) -> DataFrame:
    t = F.col(f"`{text}`")
    return docs.select(F.coalesce(F.col(f"`{id}`").cast("long"), F.lit(NO_ID)).alias("id"), F.xxhash64(t).alias("text_key"), t.alias("text"))


def spans(docs: DataFrame, id: str = "doc_id", text: str = "text", window: int = WINDOW, gram: int = GRAM) -> DataFrame:
    """id, text_key and the runs of repeated windows: windows low to low + n - 1 start a passage seen in a smaller id."""
    phrases = _asked(docs, id, text).mapInPandas(_parsed(window, gram), _PHRASE)
    return whole_groups(phrases, ["anchor"], _factored, _SPAN)


def _kept(window: int):
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            total, removed, kept = [], [], []
            for text, lows, ns in zip(batch["text"], batch["lows"], batch["ns"]):
                words = _split(text)
                keep = np.ones(len(words), bool)
                if lows is not None:
                    for a, n in zip(lows, ns):
                        keep[a : a + n + window - 1] = False
                total.append(len(words))
                removed.append(int((~keep).sum()))
                kept.append(" ".join(words if keep.all() else [w for w, k in zip(words, keep) if k]))
            yield pd.DataFrame({"id": batch["id"], "n_words": total, "n_removed": removed, "kept": kept})

    return run


_SPACES = {ord(c): " " for c in "\t\n\x0b\x0c\r"}


def _split(text: str | None) -> list[str]:
    return [w for w in (text or "").translate(_SPACES).split(" ") if w]


def remove(docs: DataFrame, id: str = "doc_id", text: str = "text", window: int = WINDOW, gram: int = GRAM) -> DataFrame:
    """id, n_words, n_removed and the kept words, joined by one space, of every row."""
    found = spans(docs, id, text, window, gram).groupBy("id", "text_key").agg(F.collect_list(F.struct("low", "n")).alias("runs"))
    merged = found.select(F.col("id").alias("_id"), F.col("text_key").alias("_key"), F.col("runs.low").alias("lows"), F.col("runs.n").alias("ns"))
    kept = store(merged, "spans")
    asked = _asked(docs, id, text)
    marked = joined(asked, kept, (F.col("id") == F.col("_id")) & (F.col("text_key") == F.col("_key")), "left")
    out = marked.select("id", "text", "lows", "ns").mapInPandas(_kept(window), "id bigint, n_words bigint, n_removed bigint, kept string")
    return out.withColumn("id", F.when(F.col("id") != NO_ID, F.col("id")))


@query()
def op9_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = remove(table(spark, sf_dir, "documents").select("doc_id", "text"))
    return found.select(
        F.col("id").alias("doc_id"), "n_words", "n_removed", F.sha2(F.encode("kept", "UTF-8"), 256).alias("kept_sha256")
    )
