"""Token ids of whole texts by the tokenizers library, encoding every distinct word once.

A tokenizer qualifies when its file says that white space is dropped before the
merges and that its normaliser works on every white-space-delimited word alone.
Then the ids of a text are the ids of its words in order.  For any other
tokenizer file the whole texts are encoded.
"""

from __future__ import annotations

import json
import os
import re
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

from tessera.llm.text_blocks import no_cycle_search, split_words

MAX_CACHED_WORDS = 100_000


@lru_cache(maxsize=4)
def _tokenizer(path: str):
    os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")  # Spark runs one task per core already
    from tokenizers import Tokenizer

    tok = Tokenizer.from_file(path)
    tok.no_truncation()
    tok.no_padding()
    return tok


#: A splitter that drops white space and keeps runs of letters, single digits and runs of anything else apart.
LETTERS_DIGITS_REST = r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"


@lru_cache(maxsize=4)
def word_mode(path: str) -> str:
    """'texts', 'words' or 'cores': what can be encoded alone, by what the tokenizer's file says.

    'words' if the ids of a text are those of its white-space-delimited words in
    order; 'cores' if, besides, plain punctuation after a letter or digit is
    always a unit of its own and letters are lower-cased.
    """
    with open(path, encoding="utf-8") as f:
        spec = json.load(f)

    def parts(x, many):
        return [] if x is None else x[many] if x["type"] == "Sequence" else [x]

    normalizers = parts(spec["normalizer"], "normalizers")
    by_word = all(
        n["type"] in ("NFC", "NFD", "Lowercase") or n["type"] == "Replace" and n["pattern"].get("Regex") == r"\s+"
        and n["content"] == " " for n in normalizers)
    first = next(iter(parts(spec["pre_tokenizer"], "pretokenizers")), {"type": None})
    known = (first["type"] == "Split" and first["behavior"] == "Removed" and first["invert"]
             and first["pattern"].get("Regex") == LETTERS_DIGITS_REST)
    plain = not any(a["lstrip"] or a["rstrip"] or any(c.isspace() for c in a["content"]) or a["content"][-1:].isalnum()
                    or a["content"].isalpha() for a in spec["added_tokens"])
    if not (by_word and plain and (known or first["type"] in ("WhitespaceSplit", "BertPreTokenizer"))):
        return "texts"
    return "cores" if known and any(n["type"] == "Lowercase" for n in normalizers) else "words"


#: Ids of the words seen last, by tokenizer: those of this generation and of the one before.
_CACHE: dict[str, tuple[dict[str, bytes], dict[str, bytes]]] = {}


def _word_ids(path: str, words: list[str]) -> list[bytes]:
    """Little-endian unsigned 32-bit ids of every word, kept between blocks for a bounded number of words."""
    new, old = _CACHE.setdefault(path, ({}, {}))
    coded = list(map(new.get, words))
    for i, ids in enumerate(coded):
        if ids is None and (ids := old.get(words[i])) is not None:
            coded[i] = new[words[i]] = ids
    missing = [i for i, ids in enumerate(coded) if ids is None]
    for at in range(0, len(missing), 8192):
        part = missing[at:at + 8192]
        for i, ids in zip(part, _encode_words(path, [words[i] for i in part]), strict=True):
            coded[i] = new[words[i]] = ids
    if len(new) > MAX_CACHED_WORDS // 2:
        _CACHE[path] = ({}, new)
    return coded


@lru_cache(maxsize=4)
def _word_ends(path: str) -> np.ndarray:
    """For every id, whether its token ends a unit of the splitter."""
    tok = _tokenizer(path)
    suffix = tok.model.end_of_word_suffix
    ends = np.zeros(tok.get_vocab_size(with_added_tokens=True), bool)
    if suffix:
        for token, i in tok.get_vocab(with_added_tokens=False).items():
            ends[i] = token.endswith(suffix)
    return ends


#: Runs of these letters are one unit of the splitter, whatever the normaliser does to them.
_PLAIN_LETTERS = re.compile(r"[A-Za-zÀ-ÖØ-öø-ÿ]+").fullmatch


def _encode_words(path: str, words: list[str], joined: int = 64) -> list[bytes]:
    """Ids of every word.

    Runs of plain letters go through the library by lines of several and are cut
    apart after each token that ends a unit; other words go one by one.
    """
    tok, ends = _tokenizer(path), _word_ends(path)
    plain = [i for i, w in enumerate(words) if _PLAIN_LETTERS(w)] if word_mode(path) == "cores" and ends.any() else []
    out: list[bytes | None] = [None] * len(words)
    lines = [" ".join(words[i] for i in plain[k:k + joined]) for k in range(0, len(plain), joined)]
    ids = [np.array(e.ids, dtype="<u4") for e in tok.encode_batch_fast(lines, add_special_tokens=False)]
    if ids:
        ids = np.concatenate(ids)
        cuts = np.flatnonzero(ends[ids]) + 1
        if len(cuts) != len(plain):
            raise ValueError("a run of letters is not one unit of this tokenizer")
        raw, begin = ids.tobytes(), 0
        for i, end in zip(plain, (cuts * 4).tolist(), strict=True):
            out[i] = raw[begin:end]
            begin = end
    rest = [i for i, ids_ in enumerate(out) if ids_ is None]
    for i, e in zip(rest, tok.encode_batch_fast([words[i] for i in rest], add_special_tokens=False), strict=True):
        out[i] = np.array(e.ids, dtype="<u4").tobytes()
    return out


def _simplified(vocab: pa.Array) -> tuple[pa.Array, pa.Array]:
    """Every word as a core and an end of plain punctuation, which the splitter cuts off anyway.

    Words of ASCII letters only are lower-cased, as the normaliser does.
    """
    parts = pc.extract_regex(vocab, r"(?s)^(?P<core>.*[A-Za-z0-9À-ÖØ-öø-ÿ])(?P<end>[.,!?;:]+)$")
    core = pc.coalesce(pc.struct_field(parts, "core"), vocab)
    end = pc.fill_null(pc.struct_field(parts, "end"), "")
    letters = pc.and_(pc.string_is_ascii(core), pc.utf8_is_alpha(core))
    return pc.if_else(letters, pc.ascii_lower(core), core), end


def encode_block(path: str, text: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """All ids of a block of texts, and where each text's ids begin (one more entry than texts)."""
    with no_cycle_search():
        return _encode_block(path, text)


def _encode_block(path: str, text: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    if word_mode(path) == "texts":
        encoded = [e.ids for e in _tokenizer(path).encode_batch_fast(text.to_pylist(), add_special_tokens=False)]
        starts = np.concatenate(([0], np.cumsum([len(e) for e in encoded], dtype=np.int64)))
        return np.array([i for e in encoded for i in e], dtype="<u4"), starts
    words = split_words(text)
    segments = [words.vocab] if word_mode(path) == "words" else _simplified(words.vocab)
    begin, length, flat, done = [], [], [], 0  # of every distinct word, segment by segment
    for segment in segments:
        coded = segment.dictionary_encode()
        ids = _word_ids(path, coded.dictionary.to_pylist())
        n = np.fromiter(map(len, ids), np.int64, len(ids)) // 4
        own = coded.indices.to_numpy(zero_copy_only=False)
        begin.append((done + np.cumsum(n) - n)[own])
        length.append(n[own])
        flat += ids
        done += int(n.sum())
    ids, ends = _gather(np.frombuffer(b"".join(flat), dtype="<u4"), np.stack(begin, 1).ravel(), np.stack(length, 1).ravel())
    ends = ends[::len(segments)]
    ids, ends = _gather(ids, ends[:-1][words.ids], np.diff(ends)[words.ids])
    return ids, ends[words.starts]


def _gather(flat: np.ndarray, begin: np.ndarray, length: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The runs of ``flat`` one after another, and where each begins (one more entry than runs)."""
    ends = np.concatenate((np.zeros(1, np.int64), np.cumsum(length, dtype=np.int64)))
    place = np.arange(ends[-1]) + np.repeat(begin - ends[:-1], length)
    return flat[place], ends
