"""Whole-text encoding with a public tokenizer inside Spark tasks.

``Encoder`` gives the ids that ``Tokenizer.encode(text, add_special_tokens=
False)`` gives, as little-endian unsigned 32-bit integers.  A byte-level BPE
whose pre-tokenizer starts a new piece at a single space between two non-space
characters encodes the chunks between such spaces independently of each other,
so each distinct chunk is encoded once and remembered.  A text in which a
space or line end is next to other white space goes to the tokenizer whole, and so does
every text where the tokenizer is of another kind.
"""

from __future__ import annotations

import gc
import json
import os
import re
import sys
from array import array
from itertools import islice

import numpy as np

#: Distinct chunks that a Python worker remembers; it then forgets the later half.
MAX_CHUNKS = 500_000

_ENCODERS: dict = {}


def default_tokenizer() -> str:
    """Path of the public 50k byte-level BPE."""
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.json")


def vocabulary_size(path: str) -> int:
    from tokenizers import Tokenizer

    return Tokenizer.from_file(path).get_vocab_size(with_added_tokens=True)


def encoder(path: str) -> "Encoder":
    """One encoder for each worker process and vocabulary file."""
    if path not in _ENCODERS:
        _ENCODERS[path] = Encoder(path)
    return _ENCODERS[path]


#: Letters that every Unicode version and regular expression library agrees on,
#: after what may come before a chunk (a text's start or a line's end), and ASCII
#: marks after them: the pre-tokenizer parts a chunk of this form just so.
PIECE = re.compile("([ \n]?)([A-Za-z\u00c0-\u00d6\u00d8-\u00f6\u00f8-\u01ba]+)([!-&(-/:-@\\[-^`{-~]*)\\Z")


def byte_letters() -> dict[int, str]:
    """The letter that stands for each byte in a byte-level vocabulary: printable
    bytes for themselves, the others in order from U+0100 on."""
    own = [b for b in range(256) if chr(b).isprintable() and b not in (0x20, 0xA0, 0xAD)]
    out = {b: chr(b) for b in own}
    for k, b in enumerate(b for b in range(256) if b not in out):
        out[b] = chr(256 + k)
    return out


def _packed(ids) -> bytes:
    a = array("I", ids)
    if sys.byteorder == "big":
        a.byteswap()
    return a.tobytes()


class Encoder:
    def __init__(self, path: str, max_chunks: int = MAX_CHUNKS):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.max_chunks = max_chunks
        # chunk -> ids of " chunk"; " chunk" -> ids of the chunk that starts a
        # text; "\\nchunk" -> its ids; False: the chunk touches other white space
        self.known: dict = {}
        self.tokenize = self.tokenizer.model.tokenize
        self.letter = byte_letters()
        self.space = self.letter[32]
        self.marks: dict = {}
        self.line = _packed(self.tokenizer.encode("\n", add_special_tokens=False).ids)
        rules = json.loads(self.tokenizer.to_str())
        split = rules["pre_tokenizer"] or {}
        self.parts = (rules["normalizer"] is None and rules["model"]["type"] == "BPE"
                      and split.get("type") == "ByteLevel" and split.get("use_regex", True)
                      and not split["add_prefix_space"])
        self.bytes_of_id = np.array([len(self.tokenizer.id_to_token(i) or "")
                                     for i in range(self.tokenizer.get_vocab_size())])

    def encode(self, texts: list) -> list[bytes]:
        """Ids of each text (None: no ids), as uint32 bytes."""
        out: list[bytes] = []
        collecting = gc.isenabled()
        gc.disable()  # there are only lists of strings here, and very many
        try:
            for i in range(0, len(texts), 256):
                out += self._some([t or "" for t in texts[i:i + 256]])
        finally:
            if collecting:
                gc.enable()
        return out

    def _some(self, texts: list[str]) -> list[bytes]:
        if not self.parts:
            return [_packed(e.ids) for e in
                    self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)]
        if len(self.known) > self.max_chunks:  # common chunks came early
            self.known = dict(islice(self.known.items(), self.max_chunks // 2))
        get = self.known.get
        rows, new = [], {}
        for t in texts:
            parts = t.replace("\n", " \n").split(" ")
            parts[0] = " " + parts[0]
            ids = list(map(get, parts))
            gaps = {}
            if None in ids:
                gaps = {k: c for k, (c, x) in enumerate(zip(parts, ids)) if x is None}
                new.update(dict.fromkeys(gaps.values()))
            rows.append((ids, gaps))
        self._learn(new)
        out = []
        for t, (ids, gaps) in zip(texts, rows):
            for k, c in gaps.items():
                ids[k] = get(c)
            try:
                out.append(b"".join(ids))
            except TypeError:
                out.append(_packed(self.tokenizer.encode(t, add_special_tokens=False).ids))
        return out

    def _learn(self, chunks: dict) -> None:
        known, marks, inner = self.known, self.marks, []
        tokenize, piece, table, space = self.tokenize, PIECE.match, self.letter, self.space
        for c in chunks:
            m = piece(c)
            if m:
                lead, word, mark = m.groups()
                ids = known.get(word) if mark and not lead else None
                if not ids:  # the model takes bytes as the letters that stand for them
                    if not word.isascii():
                        word = word.encode().decode("latin-1").translate(table)
                    ids = _packed([x.id for x in tokenize(word if lead else space + word)])
                if mark:
                    if mark not in marks:
                        marks[mark] = _packed(self.tokenizer.encode(mark, add_special_tokens=False).ids)
                    ids += marks[mark]
                known[c] = self.line + ids if lead == "\n" else ids
                continue
            first = c[:1] == " "
            body = c[1:] if first or c[:1] == "\n" else c
            if body[-1:].isspace() or not first and (not body or body[0].isspace()):
                known[c] = False
            elif body is not c:
                known[c] = _packed(self.tokenizer.encode(body if first else c, add_special_tokens=False).ids)
            else:
                inner.append(c)
        if not inner:
            return
        # one text of all other chunks; the byte lengths of the ids tell them apart
        text = " " + " ".join(inner)
        ids = np.array(self.tokenizer.encode_batch_fast([text], add_special_tokens=False)[0].ids, dtype="<u4")
        raw = text.encode()
        ends = np.append(np.nonzero(np.frombuffer(raw, np.uint8) == 32)[0][1:], len(raw))
        cuts = ((np.searchsorted(np.cumsum(self.bytes_of_id[ids]), ends) + 1) * 4).tolist()
        packed = ids.tobytes()
        known.update(zip(inner, map(packed.__getitem__, map(slice, [0, *cuts], cuts))))
