"""Token ids of whole texts by the tokenizers library, with a memo for white-space-delimited chunks.

``word_bpe`` files normalise (NFC, white space to one space, lower case), split
into letters, digits and other runs, none of which crosses white space, and
then apply BPE inside each run. ASCII white space is never part of a special
token either, and no character composes with it. So the ids of a text are the
ids of its chunks between ASCII white space, one after the other, and a chunk
met before need not be encoded again. ``Encoder`` checks that the file is of
this kind; other files are encoded text by text. ``Encoder.batch`` has Arrow find
the distinct chunks of many texts, and of those the distinct runs of letters and of
marks in lower case, so that the memo is asked once for each of these.
"""

from __future__ import annotations

import array
import json
import re

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import regex
from tokenizers import Tokenizer

#: Chunks, and runs, kept by a worker before the memo starts anew (about 70 MB).
MEMO = 200_000
#: The split rule of the file kind that the memo is proven for (fixed value).
SPLIT_RULE = "'s|'t|'re|'ve|'m|'ll|'d|[\\p{L}]+|[\\p{N}]|[^\\s\\p{L}\\p{N}]+"
NORMALIZERS = ["NFC", "Replace", "Lowercase"]
#: Up to U+024F every character but the excluded ones is NFC and lowers alone.
_PLAIN = re.compile("[!-~¡-įı-ɏ]+")
#: Letters, then marks that hold no apostrophe: exactly one or two runs.
_WORD = re.compile("([A-Za-zÀ-ÖØ-öø-įı-ɏ]+)([!-&(-/:-@\\[-`{-~]*)")
#: The same for Arrow.
_WORD_GROUPS = "^(?P<letters>[A-Za-zÀ-ÖØ-öø-įı-ɏ]+)(?P<marks>[!-&(-/:-@\\[-`{-~]*)$"


def _byte_alphabet() -> dict[int, str]:
    """The printable character that stands for each byte in byte-level vocabularies."""
    shown = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = [b for b in range(256) if b not in set(shown)]
    return {b: chr(b) for b in shown} | {b: chr(256 + i) for i, b in enumerate(rest)}


class Encoder:
    """Ids of texts (UTF-8 bytes) as little-endian unsigned 32-bit integers."""

    def __init__(self, path: str):
        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.no_truncation()
        self.tokenizer.no_padding()
        with open(path, encoding="utf-8") as f:
            kind = json.load(f)
        self.by_chunk = _chunkable(kind)
        self.units: dict[str, bytes] = {}
        self.chunks = _Chunks(self)
        self.shown = str.maketrans({chr(b): c for b, c in _byte_alphabet().items()})
        self.model = self.tokenizer.model
        self.split = regex.compile(SPLIT_RULE)

    def whole(self, text: str) -> bytes:
        return array.array("I", self.tokenizer.encode(text, add_special_tokens=False).ids).tobytes()

    def unit(self, run: str) -> bytes:
        ids = self.units.get(run)
        if ids is None:
            if len(self.units) >= MEMO:
                self.units.clear()
            shown = run if run.isascii() else run.encode().decode("latin-1").translate(self.shown)
            ids = self.units[run] = array.array("I", [t.id for t in self.model.tokenize(shown)]).tobytes()
        return ids

    def chunk(self, text: str) -> bytes:
        if "<|" not in text:
            if word := _WORD.fullmatch(text):
                letters, marks = word.groups()
                return self.unit(letters.lower()) + self.unit(marks) if marks else self.unit(letters.lower())
            if _PLAIN.fullmatch(text):
                return b"".join(map(self.unit, self.split.findall(text.lower())))
        return self.whole(text)

    def ids(self, text: bytes) -> bytes:
        if not self.by_chunk:
            return self.whole(text.decode("utf-8", "replace"))
        if len(self.chunks) >= MEMO:
            self.chunks.clear()
        return b"".join(map(self.chunks.__getitem__, text.split()))

    def batch(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all texts (an array of UTF-8 bytes without nulls), one after the other, and the n+1 offsets of the texts in them."""
        if not self.by_chunk:
            return _laid_out(pa.array(map(self.ids, texts.to_pylist()), pa.large_binary()))
        # Looked at as they are: bytes that aren't UTF-8 match no pattern. Chunks before or after all others may be empty and have no ids.
        split = pc.ascii_split_whitespace(pa.Array.from_buffers(pa.string(), len(texts), texts.buffers(), offset=texts.offset))
        chunks = split.flatten().dictionary_encode()
        known = chunks.dictionary
        words = pc.extract_regex(known, _WORD_GROUPS)
        words = pc.if_else(pc.match_substring(known, "<|"), pa.scalar(None, words.type), words)
        letters, marks = pc.utf8_lower(pc.struct_field(words, "letters")), pc.struct_field(words, "marks")
        ids = pc.binary_join_element_wise(self._runs(letters), self._runs(marks), pa.scalar(b"", pa.large_binary()))
        others = pc.indices_nonzero(ids.is_null())
        found = [self.chunk(c.decode("utf-8", "replace")) for c in known.take(others).cast(pa.binary()).to_pylist()]
        ids = pc.replace_with_mask(ids, ids.is_null(), pa.array(found, pa.large_binary()))
        ids, places = _laid_out(ids.take(chunks.indices))
        starts = np.asarray(split.offsets, np.int64)
        return ids, places[starts - starts[0]]

    def _runs(self, runs: pa.Array) -> pa.Array:
        """Ids of lower-case runs; the memo is asked once for each distinct one. Null stays null."""
        runs = runs.dictionary_encode()
        found = map(self.unit, runs.dictionary.to_numpy(zero_copy_only=False).tolist())
        return pa.array(found, pa.large_binary()).take(runs.indices)


def _laid_out(ids: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The ids of all rows and the offsets of the rows in them."""
    offsets = np.frombuffer(ids.buffers()[1], np.int64)[ids.offset : ids.offset + len(ids) + 1] // 4
    data = ids.buffers()[2]
    flat = np.frombuffer(data, "<u4", count=data.size // 4) if data is not None else np.zeros(0, "<u4")
    return flat[offsets[0] : offsets[-1]], offsets - offsets[0]


class _Chunks(dict):
    def __init__(self, encoder: Encoder):
        self.encoder = encoder

    def __missing__(self, chunk: bytes) -> bytes:
        ids = self[chunk] = self.encoder.chunk(chunk.decode("utf-8", "replace"))
        return ids


def _chunkable(kind: dict) -> bool:
    normalizer, pre, model = (kind.get(k) or {} for k in ("normalizer", "pre_tokenizer", "model"))
    names = [n.get("type") for n in normalizer.get("normalizers", [])]
    replace = [n for n in normalizer.get("normalizers", []) if n.get("type") == "Replace"]
    parts = pre.get("pretokenizers", [])
    return (
        names == NORMALIZERS
        and [(n["pattern"], n["content"]) for n in replace] == [({"Regex": "\\s+"}, " ")]
        and [p.get("type") for p in parts] == ["Split", "ByteLevel"]
        and parts[0]["pattern"] == {"Regex": SPLIT_RULE}
        and parts[0]["behavior"] == "Removed"
        and parts[0]["invert"]
        and not parts[1]["add_prefix_space"]
        and not parts[1]["use_regex"]
        and model.get("type") == "BPE"
        and model.get("dropout") is None
        and not any(re.search(r"\s", t["content"]) or "<|" != t["content"][:2] or t["lstrip"] or t["rstrip"] or t["single_word"] or t["normalized"] for t in kind.get("added_tokens", []))
    )


_ENCODERS: dict[str, Encoder] = {}


def encoder(path: str) -> Encoder:
    """One encoder per worker and file."""
    if path not in _ENCODERS:
        _ENCODERS[path] = Encoder(path)
    return _ENCODERS[path]
