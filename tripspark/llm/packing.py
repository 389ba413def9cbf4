"""Token-id output: best-fit-decreasing packing into rows of one context length.

1. Whole texts are encoded, ended by the end id, and cut into pieces of at most
   ``length`` ids; joined again in order, a document's pieces are its ids.
2. Pieces go to shards by a hash of document and piece. The number of shards
   follows from the bytes of text, so a shard is bounded whatever the input,
   and a group of copies or one huge document spreads over all of them.
3. Within a shard pieces are packed by best fit decreasing: longest first, each
   into the row with the least room that still fits. A segment tree over the
   possible rooms, 0 to ``length``, finds it in ``log(length)`` steps.
4. Each packed row holds its ids as one binary row of the id matrix (little
   endian, 2 bytes if the vocabulary fits), cumulative segment lengths, and the
   offsets at which positions start again from 0.

Defined cases: NULL and empty texts are the end id alone; equal rows are packed
each; NULL ids are kept as such; an empty table gives an empty result; extra
columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tripspark.llm.common import text_or_empty
from tripspark.llm.tokens import END_ID, VOCABULARY, encode

PACKED = ("shard int, row int, n_tokens int, input_ids binary, cu_seqlens array<int>, position_resets array<int>, "
          "doc_ids array<bigint>, pieces array<int>")
#: Rows of one output batch of the encoder.
_ROWS = 500


class RoomTree:
    """Segment tree over rooms 0..length: the open rows of each room, and the least
    room of at least a given size that has any."""

    def __init__(self, length: int):
        self.leaves = 1 << length.bit_length()
        self.count = np.zeros(2 * self.leaves, np.int64).tolist()
        self.rows: list[list[int]] = [[] for _ in range(length + 1)]

    def add(self, room: int, row: int) -> None:
        self.rows[room].append(row)
        self._change(room, 1)

    def take(self, need: int) -> tuple[int, int] | None:
        """Remove and return ``(room, row)`` of least room >= ``need``, if any."""
        i = need + self.leaves
        if not self.count[i]:
            while i > 1 and (i & 1 or not self.count[i + 1]):
                i >>= 1
            if i <= 1:
                return None
            i += 1
            while i < self.leaves:
                i = 2 * i if self.count[2 * i] else 2 * i + 1
        room = i - self.leaves
        self._change(room, -1)
        return room, self.rows[room].pop()

    def _change(self, room: int, by: int) -> None:
        i = room + self.leaves
        while i:
            self.count[i] += by
            i >>= 1


def best_fit(sizes: list[int], length: int) -> list[list[int]]:
    """Rows of positions in ``sizes``, packed in the given order, each into the fullest row it fits."""
    tree, rows = RoomTree(length), []
    for k, size in enumerate(sizes):
        found = tree.take(size)
        if found is None:
            rows.append([k])
            tree.add(length - size, len(rows) - 1)
        else:
            rows[found[1]].append(k)
            tree.add(found[0] - size, found[1])
    return rows


def encoded_pieces(docs: DataFrame, length: int, shards: int, *, id_col: str = "doc_id", text_col: str = "text",
                   vocabulary: str = VOCABULARY, end_id: int = END_ID) -> DataFrame:
    """``doc_id, piece, shard, ids``: the documents' ids in pieces of at most ``length``.

    The shard hashes id, piece and, for rows alike in both, their number within the batch."""
    kind = "<u2" if end_id < 1 << 16 else "<u4"

    def encoded(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            again = batch.groupby("doc_id", dropna=False).cumcount()
            for at in range(0, len(batch), _ROWS):
                out: list[tuple] = []
                part = batch.iloc[at:at + _ROWS]
                for doc, text, n in zip(part["doc_id"], part["text"], again.iloc[at:at + _ROWS]):
                    ids = np.append(encode(text, vocabulary), end_id).astype(kind)
                    out += [(None if pd.isna(doc) else int(doc), p, int(n), ids[s:s + length].tobytes())
                            for p, s in enumerate(range(0, len(ids), length))]
                yield pd.DataFrame(out, columns=["doc_id", "piece", "n", "ids"]).astype({"doc_id": "Int64"})

    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), text_or_empty(text_col).alias("text"))
    pieces = rows.mapInPandas(encoded, "doc_id bigint, piece int, n bigint, ids binary")
    shard = F.pmod(F.xxhash64("doc_id", "piece", "n"), F.lit(shards)).cast("int")
    return pieces.select("doc_id", "piece", shard.alias("shard"), "ids")


def pack(docs: DataFrame, *, length: int = 2048, shard_bytes: int = 8 << 20, id_col: str = "doc_id",
         text_col: str = "text", vocabulary: str = VOCABULARY, end_id: int = END_ID) -> DataFrame:
    """Packed rows (:data:`PACKED`). ``shard_bytes`` is the text that one shard packs."""
    width = 2 if end_id < 1 << 16 else 4
    total = docs.agg(F.sum(F.octet_length(text_or_empty(text_col)) + 1)).first()[0] or 0
    shards = max(1, -(-total // shard_bytes))
    pieces = encoded_pieces(docs, length, shards, id_col=id_col, text_col=text_col, vocabulary=vocabulary, end_id=end_id)
    padding = np.array([end_id], "<u2" if width == 2 else "<u4").tobytes()

    def packed(group: pd.DataFrame) -> pd.DataFrame:
        sizes = group["ids"].str.len() // width
        group = group.assign(size=sizes).sort_values(["size", "doc_id", "piece", "ids"], ascending=[False, True, True, True])
        ids, docs_, parts = group["ids"].tolist(), group["doc_id"].tolist(), group["piece"].tolist()
        sizes, shard, out = group["size"].tolist(), int(group["shard"].iloc[0]), []
        for row, members in enumerate(best_fit(sizes, length)):
            ends = np.cumsum([sizes[k] for k in members])
            n = int(ends[-1])
            out.append((shard, row, n, b"".join(ids[k] for k in members) + padding * (length - n), [0, *ends.tolist()],
                        [0, *ends[:-1].tolist()], [None if pd.isna(docs_[k]) else int(docs_[k]) for k in members],
                        [int(parts[k]) for k in members]))
        return pd.DataFrame(out, columns=["shard", "row", "n_tokens", "input_ids", "cu_seqlens", "position_resets", "doc_ids", "pieces"])

    return pieces.groupBy("shard").applyInPandas(packed, PACKED)


def write_packed(packed: DataFrame, path: str) -> None:
    """Write the id matrices with their segment lengths and position resets, one Parquet folder."""
    packed.write.mode("overwrite").parquet(path)


def segments(packed: DataFrame, width: int = 2) -> DataFrame:
    """``doc_id, piece, ids`` back out of packed rows (binary, ``width`` bytes an id)."""
    each = packed.select("input_ids", "cu_seqlens", F.posexplode(F.arrays_zip("doc_ids", "pieces")).alias("k", "s"))
    start = F.element_at("cu_seqlens", F.col("k") + 1)
    stop = F.element_at("cu_seqlens", F.col("k") + 2)
    return each.select(F.col("s.doc_ids").alias("doc_id"), F.col("s.pieces").alias("piece"),
                       F.substring(F.col("input_ids"), start * width + 1, (stop - start) * width).alias("ids"))


def position_ids(cu_seqlens: list[int], length: int) -> np.ndarray:
    """Position of each id in its segment; padding counts on as one more segment."""
    edges = np.array([*cu_seqlens, length])
    return np.arange(length) - np.repeat(edges[:-1], np.diff(edges))
