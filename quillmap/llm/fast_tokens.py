"""Exact token ids at word-cache speed.

A byte-pair tokenizer works on one pre-token at a time, so the ids of a pre-token
are looked up in a cache and only pre-tokens not met before are merged, by the same
ranks in a compiled byte-pair core (the tests hold both libraries' ids together).
Texts for which our splitting might differ from the library's (characters beyond
the Latin blocks, or anything that may be a special token) go to the library whole.
"""

from __future__ import annotations

import hashlib
import os
import re
import unicodedata
from array import array

from quillmap.llm.common import release

#: Code points for which the split below is known to be the library's.
_SAFE = "\t\n\r" + "".join(map(chr, [*range(0x20, 0x7F), *range(0xA0, 0x180)]))
_SAFE_ONLY = re.compile(f"[{re.escape(_SAFE)}]*")


def _of(kind: str) -> str:
    return re.escape("".join(c for c in _SAFE + "̇" if unicodedata.category(c)[0] == kind))


_L, _N = _of("L"), _of("N")
_S = re.escape("".join(c for c in _SAFE if c.isspace()))
_CLITICS = "'s|'t|'re|'ve|'m|'ll|'d"
#: By the pre-tokenizer's kind: byte-level text, or words without white space.
_SPLIT = {
    "bytes": re.compile(f"{_CLITICS}| ?[{_L}]+| ?[{_N}]+| ?[^{_S}{_L}{_N}]+|[{_S}]+(?![^{_S}])|[{_S}]+"),
    "words": re.compile(f"{_CLITICS}|[{_L}]+|[{_N}]|[^{_S}{_L}{_N}]+"),
}
#: Most cached pre-tokens; beyond it the cache starts anew (results are the same).
CACHED = 50_000

_loaded: dict[str, "FastTokens"] = {}


def resolve(name: str) -> str:
    """A path stays; a bare name is one of the installed public tokenizers."""
    if os.path.exists(name):
        return name
    import public_tokenizers

    return public_tokenizers.path(name)


def version_digest(name: str) -> str:
    """Digest of the tokenizer file and of the library's version: the key of stored counts."""
    import tokenizers

    with open(resolve(name), "rb") as f:
        return hashlib.sha256(f.read() + tokenizers.__version__.encode()).hexdigest()[:32]


def load(name: str) -> "FastTokens":
    """One for each Python worker and name."""
    if name not in _loaded:
        _loaded[name] = FastTokens(name)
        release()  # what parsing the file took
    return _loaded[name]


def _ranked(model: dict, added: set[str]) -> bool:
    """Whether ids can serve as ranks: plain byte-pair merges, in the order of the ids of what they make, and nothing besides."""
    if model.get("type") != "BPE" or any(model.get(k) for k in ("dropout", "unk_token", "continuing_subword_prefix", "byte_fallback", "ignore_merges", "fuse_unk")):
        return False
    pairs = [m.split(" ") if isinstance(m, str) else m for m in model["merges"]]
    made = [model["vocab"].get("".join(m)) for m in pairs]
    if not made or None in made or any(a >= b for a, b in zip(made, made[1:], strict=False)):
        return False
    merged = set(made)
    return all(i in merged or i < made[0] for t, i in model["vocab"].items() if t not in added)


def _merger(model: dict, added: set[str]):
    """ids of one pre-token. Tokens are written with a printable character for each
    byte; the end-of-word mark becomes byte 255, which no UTF-8 text has."""
    import tiktoken

    shown = [b for b in range(256) if 33 <= b < 127 or 161 <= b < 173 or 174 <= b]
    byte = {chr(b): b for b in shown} | {chr(256 + k): b for k, b in enumerate(b for b in range(256) if b not in set(shown))}
    mark = model.get("end_of_word_suffix") or ""
    ranks = {}
    for token, rank in model["vocab"].items():
        if token not in added:
            ends = bool(mark) and token.endswith(mark) and token != mark
            ranks[bytes(byte[c] for c in (token[: -len(mark)] if ends else token)) + b"\xff" * ends] = rank
    core = tiktoken.Encoding("pieces", pat_str=".", mergeable_ranks=ranks, special_tokens={})._core_bpe.encode_single_piece
    return (lambda w: core(w.encode() + b"\xff")) if mark else (lambda w: core(w.encode()))


class FastTokens:
    def __init__(self, name: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        import json

        from tokenizers import Tokenizer

        self.library = Tokenizer.from_file(path := resolve(name))
        self.library.no_truncation()
        self.library.no_padding()
        with open(path, encoding="utf-8") as f:
            j = json.load(f)
        norm, pre = j["normalizer"], j["pre_tokenizer"]
        self.lower, self.split = False, None
        if norm is None and pre == {"type": "ByteLevel", "add_prefix_space": False, "trim_offsets": True, "use_regex": True}:
            self.split = _SPLIT["bytes"]
        elif norm and [n["type"] for n in norm.get("normalizers", [])] == ["NFC", "Replace", "Lowercase"] and pre["type"] == "Sequence":
            self.lower, self.split = True, _SPLIT["words"]
        added = {t["content"] for t in j["added_tokens"]}
        if self.split is not None and not _ranked(j["model"], added):
            self.split = None  # the library then does it all
        if self.split is not None:
            self.merge = _merger(j["model"], added)
        self.special = re.compile("|".join(re.escape(t["content"][:2]) for t in j["added_tokens"]) or "(?!)")
        self.known: dict[str, bytes] = {}

    def encode(self, texts: list[str]) -> list[bytes]:
        """The ids of each text as native unsigned 32-bit integers."""
        if self.split is None:
            return [self._whole(t) for t in texts]
        pieces: list[list[str] | None] = []
        fresh: set[str] = set()
        known, find, safe, special = self.known, self.split.findall, _SAFE_ONLY.fullmatch, self.special.search
        if len(known) > CACHED:
            known.clear()
        for t in texts:
            if special(t) or not ((t.isascii() and t.isprintable()) or safe(t)):
                pieces.append(None)
                continue
            own = find(t.lower() if self.lower else t)
            pieces.append(own)
            fresh.update(own)
        merge = self.merge
        for w in fresh:
            if w not in known:
                known[w] = array("I", merge(w)).tobytes()
        return [self._whole(t) if own is None else b"".join(map(known.__getitem__, own)) for t, own in zip(texts, pieces, strict=True)]

    def _whole(self, text: str) -> bytes:
        return array("I", self.library.encode(text, add_special_tokens=False).ids).tobytes()


def slices(lengths: list[int], most: int = 1_000_000):
    """(from, to) over consecutive texts of about `most` characters together."""
    lo = size = 0
    for i, n in enumerate(lengths):
        if size and size + n > most:
            yield lo, i
            lo, size = i, 0
        size += n
    if lo < len(lengths):
        yield lo, len(lengths)


def pack_texts(batches):
    """Texts, compressed for the shuffle; the other columns stay."""
    import pyarrow as pa
    import zstandard

    z = zstandard.ZstdCompressor(level=1)
    for b in batches:
        packed = pa.array([None if t is None else z.compress(t.encode()) for t in b.column("text").to_pylist()], pa.binary())
        names = [n for n in b.schema.names if n != "text"]
        yield pa.RecordBatch.from_arrays([*(b.column(b.schema.names.index(n)) for n in names), packed], [*names, "packed"])


def unpack_texts(b):
    """Row numbers and texts of a batch with packed texts, in slices."""
    import zstandard

    z, packed = zstandard.ZstdDecompressor(), b.column("packed").to_pylist()
    for lo, hi in slices([3 * len(p or b"") for p in packed]):
        yield range(lo, hi), [z.decompress(p).decode() if p is not None else "" for p in packed[lo:hi]]
