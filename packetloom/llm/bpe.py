"""Byte-level BPE through the tokenizers library, exact and with remembered pieces.

A byte-level pre-tokeniser never lets a token cross the place before a single
space that a visible character follows: the pattern takes all but the last
blank of a run, and that last space opens the next piece. So a text may be cut
at these places and every piece encoded once; the library still produces all
ids. For a tokenizer of another kind texts are encoded whole.
"""

from __future__ import annotations

import json
import os
import re
from itertools import islice

import numpy as np

from packetloom.llm.common import alone

os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")

_RUN = re.compile(r" (?:\s|\Z)")
_CUT = re.compile(r" (?=\S)")
REMEMBERED = 600_000  # pieces kept per worker; beyond that the later half, mostly rare pieces, is forgotten
LONG_PIECE = 2_000  # characters; longer ones are not remembered

_open: dict[str, PieceEncoder] = {}


def default_path() -> str:
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.json")


def encoder(path: str) -> PieceEncoder:
    """One encoder per worker process and file."""
    alone("pieces", forget)
    if path not in _open:
        _open[path] = PieceEncoder(path)
    return _open[path]


def forget() -> None:
    """Drop the remembered pieces; the tokenizers stay open."""
    for known in _open.values():
        known.led = {}


class PieceEncoder:
    def __init__(self, path: str):
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        pre = spec.get("pre_tokenizer") or {}
        self.cuts_at_spaces = (
            spec.get("normalizer") is None and spec.get("post_processor") is None and pre.get("type") == "ByteLevel"
            and pre.get("use_regex", True) and not pre.get("add_prefix_space", True)
        )
        special = [(t["id"], t["content"]) for t in spec.get("added_tokens", [])]
        self.cuts_at_spaces &= not any(re.search(r"\s", content) for _, content in special)
        self.mark_id, self.mark = special[0] if special else (None, None)
        self.special = [content for _, content in special]
        # ids whose token begins with a blank (its letter in this alphabet is U+0120): where a led piece begins
        vocabulary = self.tokenizer.get_vocab()
        self.blank = np.zeros(max(vocabulary.values(), default=0) + 1, dtype=bool)
        self.blank[[i for token, i in vocabulary.items() if token.startswith("\u0120")]] = True
        self.longest_special = max([len(content) for _, content in special], default=0)
        self.led: dict[str, bytes] = {}  # ids of " " + key

    def ids_whole(self, text: str) -> bytes:
        ids = self.tokenizer.encode_batch_fast([text], add_special_tokens=False)[0].ids
        return np.array(ids, dtype="<u4").tobytes()

    def pieces(self, text: str) -> list[str]:
        """The first piece, then the others without the space each begins with."""
        return _CUT.split(text) if _RUN.search(text) else text.split(" ")

    def learn(self, pieces: set[str], lead: str = " ") -> dict[str, bytes]:
        """Ids of lead + piece, many pieces per call.

        Led pieces without a blank inside are put behind each other: no token crosses the blank that each begins with,
        so a piece begins where a token does that begins with a blank. Others have a special token between two.
        """
        out, led, apart = {}, [], []
        for p in pieces:
            if self.mark is None or len(p) > LONG_PIECE or any(content in p for content in self.special):
                out[p] = self.ids_whole(lead + p)
            elif lead == " " and " " not in p:
                led.append(p)
            else:
                apart.append(p)
        for group, between in ((led, " "), (apart, self.mark + lead if self.mark else "")):
            for i in range(0, len(group), 2000):
                run = group[i : i + 2000]
                flat = np.frombuffer(self.ids_whole(lead + between.join(run)), dtype="<u4")
                if group is led:
                    begins = np.flatnonzero(self.blank[flat])
                    ends = np.append(begins[1:], len(flat))
                else:
                    ends = np.append(np.flatnonzero(flat == self.mark_id), len(flat))
                    begins = np.append(0, ends[:-1] + 1)
                raw = flat.tobytes()
                for p, begin, end in zip(run, begins.tolist(), ends.tolist(), strict=True):
                    out[p] = raw[4 * begin : 4 * end]
        return out

    def ids(self, texts: list[str]) -> list[bytes]:
        """Little-endian 32-bit ids of every whole text, without special tokens added."""
        if not self.cuts_at_spaces:
            return [self.ids_whole(t) for t in texts]
        cut = [self.pieces(t) for t in texts]
        led = self.led
        missing = {p for parts in cut for p in parts[1:] if p not in led}
        if missing:
            if len(led) > REMEMBERED:
                led = self.led = dict(islice(led.items(), REMEMBERED // 2))
                missing = {p for parts in cut for p in parts[1:] if p not in led}
            led.update(self.learn(missing))
        get = led.__getitem__
        first = self.learn({parts[0] for parts in cut if parts[0]}, "")
        first[""] = b""
        out = [b"".join([first[parts[0]], *map(get, parts[1:])]) for parts in cut]
        for p in [p for p in missing if len(p) > LONG_PIECE]:
            del led[p]
        return out
