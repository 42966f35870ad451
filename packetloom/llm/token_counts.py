"""Token counts of whole documents, huge ones by overlapping chunks.

A document of at most ``chunk_chars`` characters is encoded as it is. A longer
one is encoded in chunks that overlap. Where a pre-token begins at the same
place in a chunk and in the next one, ``margin`` characters or more before the
chunk's end, the library would go on from there alike for the whole text: what
lies before the place is decided by the first chunk (a pre-token looks only a
few characters ahead, and a special string is shorter than the margin), what
follows by the second. The counts are spliced at the last such place. If an
overlap has none it is doubled, and when it would cover the whole chunk the
chunk is doubled, at worst to the rest of the text.

Null counts as empty. Empty table: no rows. Repeated rows each give a row;
further columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from packetloom.llm.bpe import PieceEncoder, default_path, encoder
from packetloom.llm.common import map_batches, slices

CHUNK_CHARS = 32_768
OVERLAP_CHARS = 256


def token_counts(
    docs: DataFrame, path: str | None = None, limit: int = 512, chunk_chars: int = CHUNK_CHARS,
    overlap_chars: int = OVERLAP_CHARS, id_col: str = "doc_id", text_col: str = "text",
) -> DataFrame:
    """doc id, n_bytes, n_tokens, over_limit, n_chunks (encoded for the row, widened tries included)."""
    path = path or default_path()

    def count(columns: dict[str, list]) -> dict[str, object]:
        enc, texts = encoder(path), columns["text"]
        tokens, chunks = [0] * len(texts), [1] * len(texts)
        for part in slices(texts, 1 << 20):
            short = [i for i in range(part.start, part.stop) if len(texts[i]) <= chunk_chars]
            for i, ids in zip(short, enc.ids([texts[i] for i in short])):
                tokens[i] = len(ids) // 4
            for i in set(range(part.start, part.stop)) - set(short):
                tokens[i], chunks[i] = resynchronised_count(enc, texts[i], chunk_chars, overlap_chars)
        return {"id": columns["id"], "n_bytes": columns["n_bytes"], "n_tokens": tokens, "n_chunks": chunks}

    id_type = docs.schema[id_col].dataType.simpleString()
    text = F.coalesce(F.col(text_col), F.lit(""))
    source = docs.select(F.col(id_col).alias("id"), text.alias("text"), F.octet_length(text).cast("long").alias("n_bytes"))
    counted = map_batches(source, count, f"id {id_type}, n_bytes long, n_tokens long, n_chunks int")
    return counted.select(F.col("id").alias(id_col), "n_bytes", "n_tokens", (F.col("n_tokens") > limit).alias("over_limit"), "n_chunks")


def starts_of(enc: PieceEncoder, text: str) -> tuple[dict[int, int], int]:
    """Place of each pre-token's first character -> number of tokens before it; tokens in all."""
    coded = enc.tokenizer.encode(text, add_special_tokens=False)
    starts, last = {}, object()
    for k, (word, (begin, _)) in enumerate(zip(coded.word_ids, coded.offsets)):
        if word is None or word != last:
            starts[begin] = k
        last = word
    return starts, len(coded.ids)


def resynchronised_count(enc: PieceEncoder, text: str, chunk: int, overlap: int) -> tuple[int, int]:
    """Tokens of the whole text and chunks encoded on the way."""
    margin = max(16, enc.longest_special + 3)
    size, begin, end = len(text), 0, chunk
    total, encoded, splice = 0, 1, 0  # splice: tokens of the current chunk already counted elsewhere
    starts, count = starts_of(enc, text[:end])
    while end < size:
        width, found = max(overlap, 2 * margin), None
        while found is None and width < end - begin:
            after = end - width
            after_starts, after_count = starts_of(enc, text[after : after + chunk])
            encoded += 1
            # the following chunk's own first place is no evidence: it starts there anyway
            common = [p for p in starts if begin + p > after and begin + p <= end - margin and starts[p] >= splice
                      and begin + p - after in after_starts]
            if common and after + chunk > end:
                found = max(common)
            else:
                width *= 2
        if found is None:
            end = min(size, begin + 2 * (end - begin))
            starts, count = starts_of(enc, text[begin:end])
            encoded += 1
            continue
        total += starts[found] - splice
        splice = after_starts[begin + found - after]
        begin, end, starts, count = after, min(size, after + chunk), after_starts, after_count
    return total + count - splice, encoded
