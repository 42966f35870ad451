"""Vector best-fit: documents into sequences under token, document-count and attention-cost capacities.

Every document is tokenised in the tasks; one longer than a sequence is cut so
that its last pieces are full. What is packed is a row of numbers per piece.
Pieces are dealt at random into groups of about ``group_pieces`` and every
group is packed on its own, longest piece first: a piece goes to the open
sequence whose residual vector (tokens, documents, sum of squared lengths) has
room in every component and is left smallest by weighted norm ("norm"), or
fits it best by weighted dot product ("dot"). A group loses at most its last,
half-filled sequences, so the number of groups costs next to nothing, and no
task sees more than one group.

Null text is an empty document (one piece, the end id alone). Empty table: no
rows. Repeated rows are packed as often as they occur.
"""

from __future__ import annotations

import zlib
from math import ceil

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from packetloom.llm.bpe import default_path, encoder
from packetloom.llm.common import map_batches, slices, store

SEQUENCE_TOKENS = 2048
END_ID = 0
MAX_DOCUMENTS = 2048  # as many as there are tokens: one document has one at least
GROUP_PIECES = 20_000


def token_pieces(
    docs: DataFrame, path: str | None = None, capacity: int = SEQUENCE_TOKENS, id_col: str = "doc_id",
    text_col: str = "text",
) -> DataFrame:
    """doc id, piece, start, length, ids_crc32 of every piece."""
    path = path or default_path()

    def cut(columns: dict[str, list]) -> dict[str, object]:
        enc, out = encoder(path), {k: [] for k in ("id", "piece", "start", "length", "ids_crc32")}
        tail = np.array([END_ID], dtype="<u4").tobytes()
        for part in slices(columns["text"], 1 << 20):
            for key, ids in zip(columns["id"][part], enc.ids(columns["text"][part])):
                ids += tail
                size, begin, piece = len(ids) // 4, 0, 0
                while begin < size:
                    end = begin + (size - begin - 1) % capacity + 1
                    out["id"].append(key)
                    out["piece"].append(piece)
                    out["start"].append(begin)
                    out["length"].append(end - begin)
                    out["ids_crc32"].append(zlib.crc32(ids[4 * begin : 4 * end]))
                    begin, piece = end, piece + 1
        return out

    id_type = docs.schema[id_col].dataType.simpleString()
    source = docs.select(F.col(id_col).alias("id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    cut_up = map_batches(source, cut, f"id {id_type}, piece int, start long, length long, ids_crc32 long")
    return cut_up.withColumnRenamed("id", id_col)


def fit(
    lengths: np.ndarray, capacities: tuple[float, float, float], weights: tuple[float, float, float], choose: str = "norm",
) -> tuple[np.ndarray, np.ndarray]:
    """Bin and offset of every piece; ``lengths`` must not increase."""
    cap, weight = np.array(capacities, dtype=float), np.array(weights, dtype=float)
    room = np.empty((3, 1024))
    used = 0
    names = np.empty(1024, dtype=np.int64)
    bins, offsets, filled = np.empty(len(lengths), dtype=np.int64), np.empty(len(lengths), dtype=np.int64), []
    least = float(lengths[-1]) if len(lengths) else 0.0
    dead = 0
    for k, length in enumerate(lengths.tolist()):
        need = np.array([length, 1.0, float(length) * length])
        if (need > cap).any():
            raise ValueError(f"a piece of {length} tokens fits no sequence")
        live = room[:, :used]
        ok = np.flatnonzero((live[0] >= need[0]) & (live[1] >= 1.0) & (live[2] >= need[2]))
        if len(ok):
            if choose == "norm":
                left = (live[:, ok] - need[:, None]) / cap[:, None]
                at = ok[np.argmin(weight @ (left * left))]
            else:
                at = ok[np.argmax((weight * need / cap / cap) @ live[:, ok])]
        else:
            if used == room.shape[1]:
                room, names = np.concatenate([room, np.empty_like(room)], axis=1), np.concatenate([names, np.empty_like(names)])
            at, used = used, used + 1
            room[:, at], names[at] = cap, len(filled)
            filled.append(0)
        room[:, at] -= need
        name = names[at]
        bins[k], offsets[k] = name, filled[name]
        filled[name] += length
        if room[0, at] < least or room[1, at] < 1.0 or room[2, at] < least * least:
            room[0, at] = -1.0  # nothing to come fits
            dead += 1
            if dead > 256 and dead * 4 > used:
                keep = np.flatnonzero(room[0, :used] >= 0)
                room[:, : len(keep)], names[: len(keep)] = room[:, keep], names[keep]
                used, dead = len(keep), 0
    return bins, offsets


def pack(
    docs: DataFrame, path: str | None = None, capacity: int = SEQUENCE_TOKENS, max_documents: int = MAX_DOCUMENTS,
    attention_cost: float | None = None, weights: tuple[float, float, float] = (1.0, 0.05, 0.05), choose: str = "norm",
    group_pieces: int = GROUP_PIECES, id_col: str = "doc_id", text_col: str = "text",
) -> DataFrame:
    """Every piece with its sequence_id and offset. ``attention_cost`` bounds the sum of squared lengths."""
    caps = (capacity, max_documents, attention_cost or float(capacity) ** 2)
    pieces = store(
        token_pieces(docs, path, capacity, id_col, text_col).withColumn("_row", F.monotonically_increasing_id()), "pieces")
    groups = max(1, ceil(pieces.count() / group_pieces))
    names = [id_col, "piece", "start", "length", "ids_crc32"]

    def of_group(key: tuple, frame: pd.DataFrame) -> pd.DataFrame:
        frame = frame.sort_values(["length", "_row"], ascending=[False, True])
        bins, offsets = fit(frame["length"].to_numpy(), caps, weights, choose)
        return frame[names].assign(sequence_id=(int(key[0]) << 32) + bins, offset=offsets)

    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in pieces.select(names).schema)
    dealt = pieces.withColumn("_group", F.pmod(F.xxhash64("_row"), F.lit(groups)))
    return dealt.groupBy("_group").applyInPandas(of_group, f"{schema}, sequence_id long, `offset` long")
