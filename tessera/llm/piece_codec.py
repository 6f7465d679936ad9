"""SentencePiece encoding and decoding by the tokenizers library (operator 7).

The model's protobuf is parsed and rebuilt for the tokenizers library: its
normaliser, the white-space marker with or without a leading one, unigram
scores or (for a merge model) the merges that its scores imply, and byte
fallback.  Texts are encoded in batches by several threads, and every result is
checked against the SentencePiece library.

If no piece of a merge model holds a marker after another character, no merge
crosses the border before a marker.  Then a text's ids are those of its units
(white space and the run up to the next one), every distinct unit of a block is
encoded, decoded and checked once, and equality of all units is equality of the
text.  For other models whole texts are encoded and checked.
"""

from __future__ import annotations

import os
import re
import zlib
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tessera.llm.text_blocks import no_cycle_search, text_blocks

MARKER = "▁"
BLOCK_BYTES = 8 << 20
MAX_CACHED_UNITS = 100_000
THREADS = 2
_UNITS = re.compile(" +[^ ]*")


@lru_cache(maxsize=4)
def _proto(path: str):
    from sentencepiece import sentencepiece_model_pb2 as pb

    proto = pb.ModelProto()
    with open(path, "rb") as f:
        proto.ParseFromString(f.read())
    return proto


@lru_cache(maxsize=4)
def _reference(path: str):
    import sentencepiece

    return sentencepiece.SentencePieceProcessor(model_file=path)


@lru_cache(maxsize=4)
def has_units(path: str) -> bool:
    """Whether the ids of a text are those of its units."""
    proto = _proto(path)
    n = proto.normalizer_spec
    crossing = any(re.search(f"[^{MARKER}]{MARKER}", p.piece) for p in proto.pieces if p.type in (1, 4))
    return (proto.trainer_spec.model_type == 2 and not crossing and not n.precompiled_charsmap and n.add_dummy_prefix
            and not n.remove_extra_whitespaces and not proto.trainer_spec.treat_whitespace_as_suffix)


def merges_of(proto) -> list[tuple[str, str]]:
    """Pairs of pieces that make a piece, by the made piece's score, best first."""
    normal = {p.piece: p.score for p in proto.pieces if p.type in (1, 4)}
    found = []
    for piece, score in normal.items():
        for i in range(1, len(piece)):
            if piece[:i] in normal and piece[i:] in normal:
                found.append((-score, piece[:i], piece[i:]))
    found.sort(key=lambda m: (m[0], len(m[1]), m[1]))
    return [(a, b) for _, a, b in found]


@lru_cache(maxsize=4)
def build_tokenizer(path: str, leading_marker: bool = True):
    """The model as a tokenizer of the tokenizers library; without ``leading_marker`` for units that begin with one."""
    os.environ.setdefault("RAYON_NUM_THREADS", str(THREADS))
    from tokenizers import Regex, Tokenizer, decoders, models, normalizers, pre_tokenizers

    proto = _proto(path)
    spec, trainer = proto.normalizer_spec, proto.trainer_spec
    unk = next((p.piece for p in proto.pieces if p.type == 2), None)
    if trainer.model_type == 1:
        model = models.Unigram([(p.piece, p.score) for p in proto.pieces], unk_id=trainer.unk_id, byte_fallback=trainer.byte_fallback)
    elif trainer.model_type == 2:
        model = models.BPE({p.piece: i for i, p in enumerate(proto.pieces)}, merges_of(proto), unk_token=unk,
                           fuse_unk=True, byte_fallback=trainer.byte_fallback)
    else:
        raise ValueError("only unigram and merge models are supported")
    tok = Tokenizer(model)
    steps = [normalizers.Precompiled(spec.precompiled_charsmap)] if spec.precompiled_charsmap else []
    if spec.remove_extra_whitespaces:
        steps += [normalizers.Strip(), normalizers.Replace(Regex(" {2,}"), " ")]
    if spec.add_dummy_prefix and leading_marker:
        steps.append(normalizers.Prepend(MARKER))
    steps.append(normalizers.Replace(" ", MARKER))
    tok.normalizer = normalizers.Sequence(steps)
    if has_units(path):
        tok.pre_tokenizer = pre_tokenizers.Split(Regex(f"{MARKER}+[^{MARKER}]*"), "isolated")
    tok.decoder = decoders.Sequence([decoders.Replace(MARKER, " "), decoders.ByteFallback(), decoders.Fuse(),
                                     *([decoders.Strip(" ", 1, 0)] if spec.add_dummy_prefix else [])])
    return tok


@lru_cache(maxsize=4)
def _begins(path: str) -> np.ndarray:
    return np.array([p.piece.startswith(MARKER) for p in _proto(path).pieces])


def encode_texts(path: str, texts: list[str]) -> list[list[int]]:
    """Ids of whole texts, in one multithreaded batch; an empty text has none."""
    return [e.ids if t else [] for t, e in
            zip(texts, build_tokenizer(path).encode_batch_fast(texts, add_special_tokens=False), strict=True)]


def decode_texts(path: str, ids: list[list[int]]) -> list[str]:
    return build_tokenizer(path).decode_batch(ids, skip_special_tokens=False)


#: Ids, parity and round trip of the units seen last, by model: this generation and the one before.
_CACHE: dict[str, tuple[dict, dict]] = {}


def _units_coded(path: str, units: list[str]) -> list[tuple[bytes, bool, bool]]:
    """Ids (little-endian unsigned 32 bits), parity and round trip of every unit, kept between blocks for a bounded number."""
    new, old = _CACHE.setdefault(path, ({}, {}))
    coded = list(map(new.get, units))
    for i, c in enumerate(coded):
        if c is None and (c := old.get(units[i])) is not None:
            coded[i] = new[units[i]] = c
    missing = [i for i, c in enumerate(coded) if c is None]
    for at in range(0, len(missing), 8192):
        part = missing[at:at + 8192]
        for i, c in zip(part, _code(path, [units[i] for i in part]), strict=True):
            coded[i] = new[units[i]] = c
    if len(new) > MAX_CACHED_UNITS // 2:
        _CACHE[path] = ({}, new)
    return coded


def _code(path: str, units: list[str], joined: int = 64) -> list[tuple[bytes, bool, bool]]:
    """Units with one leading space go through the library by lines of several, cut apart before each token that begins with a marker."""
    tok, begins = build_tokenizer(path, leading_marker=False), _begins(path)
    plain = [i for i, u in enumerate(units) if not u.startswith("  ") and MARKER not in u]
    ids: list[bytes | None] = [None] * len(units)
    lines = ["".join(units[i] for i in plain[k:k + joined]) for k in range(0, len(plain), joined)]
    found = [np.array(e.ids, "<u4") for e in tok.encode_batch_fast(lines, add_special_tokens=False)]
    if found:
        found = np.concatenate(found)
        cuts = np.append(np.flatnonzero(begins[found]), len(found)) * 4
        if len(cuts) != len(plain) + 1:
            raise ValueError("a unit has more than one marker")
        raw = found.tobytes()
        for i, a, b in zip(plain, cuts[:-1].tolist(), cuts[1:].tolist(), strict=True):
            ids[i] = raw[a:b]
    rest = [i for i, x in enumerate(ids) if x is None]
    for i, e in zip(rest, tok.encode_batch_fast([units[i] for i in rest], add_special_tokens=False), strict=True):
        ids[i] = np.array(e.ids, "<u4").tobytes()
    # the reference library puts the first marker itself
    want = _reference(path).encode([u[1:] if len(u) > 1 else u for u in units], num_threads=THREADS)
    out = []
    lists = [np.frombuffer(x, "<u4").tolist() for x in ids]
    for u, mine, own, ref, back in zip(units, ids, lists, want, decode_texts(path, lists), strict=True):
        same = own == ref if len(u) > 1 else own == [_space_id(path)]
        out.append((mine, same, back == u[1:]))
    return out


@lru_cache(maxsize=4)
def _space_id(path: str) -> int:
    return next(i for i, p in enumerate(_proto(path).pieces) if p.piece == MARKER)


def _whole(path: str, texts: list[str]) -> list[tuple[np.ndarray, bool, bool]]:
    ids = encode_texts(path, texts)
    want, back = _reference(path).encode(texts, num_threads=THREADS), decode_texts(path, ids)
    return [(np.array(i, "<u4"), i == w, b == t) for i, w, b, t in zip(ids, want, back, texts, strict=True)]


def _block(path: str, text: pa.Array) -> list[tuple[np.ndarray, bool, bool]]:
    """Ids, parity and round trip of every text of a block."""
    if not has_units(path):
        return _whole(path, text.to_pylist())
    simple = pc.invert(pc.or_(pc.or_(pc.match_substring(text, "  "), pc.match_substring(text, MARKER)), pc.or_(
        pc.equal(text, ""), pc.or_(pc.starts_with(text, " "), pc.ends_with(text, " ")))))
    easy = np.flatnonzero(simple.to_numpy(zero_copy_only=False))
    out: list = [None] * len(text)
    if len(easy):
        parts = pc.split_pattern(text.take(pa.array(easy)), " ")
        coded = pc.list_flatten(parts).dictionary_encode()
        units = _units_coded(path, [" " + w for w in coded.dictionary.to_pylist()])
        n = np.fromiter((len(u[0]) // 4 for u in units), np.int64, len(units))
        flat = np.frombuffer(b"".join(u[0] for u in units), "<u4")
        begin = np.cumsum(n) - n
        bad = np.array([[not u[1], not u[2]] for u in units], bool)
        own = coded.indices.to_numpy(zero_copy_only=False)
        ends = np.concatenate(([0], np.cumsum(n[own])))
        ids = flat[np.arange(ends[-1]) + np.repeat(begin[own] - ends[:-1], n[own])]
        starts = np.concatenate(([0], np.cumsum(pc.list_value_length(parts).to_numpy(zero_copy_only=False))))
        wrong = np.concatenate((np.zeros((1, 2), np.int64), np.cumsum(bad[own], axis=0)))
        wrong = wrong[starts[1:]] - wrong[starts[:-1]]
        for k, i in enumerate(easy.tolist()):
            out[i] = (ids[ends[starts[k]]:ends[starts[k + 1]]], not wrong[k, 0], not wrong[k, 1])
    for i in np.setdiff1d(np.arange(len(text)), easy).tolist():
        t = text[i].as_py()
        if MARKER in t:  # the text's own markers and spaces can't be told apart
            out[i], = _whole(path, [t])
            continue
        units = _units_coded(path, _UNITS.findall(" " + t)) if t else []
        ids = np.frombuffer(b"".join(u[0] for u in units), "<u4")
        # of the first unit the marker is dropped, of the others it is a space again
        out[i] = (ids, all(u[1] for u in units), all(u[2] for u in units))
    return out


def encode_pieces(df: DataFrame, model_path: str, id_col: str = "doc_id", text_col: str = "text", keep_ids: bool = False) -> DataFrame:
    """One row per input row: ``id_col``, ``n_tokens``, ``ids_crc32``, ``parity``, ``round_trip`` and, if asked for, ``ids``.

    ``ids_crc32`` is that of the little-endian unsigned 32-bit ids; ``parity``:
    the ids are those of the SentencePiece library; ``round_trip``: decoding them
    gives the text.  No begin or end tokens.  Null and empty texts have no
    tokens.  Other columns are not read; an empty table gives no rows.
    """
    fields = [T.StructField("id", df.schema[id_col].dataType), T.StructField("n_tokens", T.LongType()), T.StructField("ids_crc32", T.LongType()),
              T.StructField("parity", T.BooleanType()), T.StructField("round_trip", T.BooleanType())]
    schema = T.StructType(fields + [T.StructField("ids", T.ArrayType(T.IntegerType()))] * keep_ids)

    def run(batches):
        for block in text_blocks(batches, "text", BLOCK_BYTES):
            with no_cycle_search():
                found = _block(model_path, block.column("text"))
            columns = [block.column("id"), pa.array([len(f[0]) for f in found], pa.int64()),
                       pa.array([zlib.crc32(np.ascontiguousarray(f[0])) for f in found], pa.int64()),
                       pa.array([bool(f[1]) for f in found]), pa.array([bool(f[2]) for f in found])]
            if keep_ids:
                columns.append(pa.array([f[0].astype(np.int32) for f in found], pa.list_(pa.int32())))
            yield pa.RecordBatch.from_arrays(columns, names=schema.names)

    return (df.select(F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("text"))
            .mapInArrow(run, schema).withColumnRenamed("id", id_col))


def decode_pieces(df: DataFrame, model_path: str, id_col: str = "doc_id", ids_col: str = "ids") -> DataFrame:
    """``id_col`` and ``text`` of every row's ids; null ids give a null text."""
    schema = T.StructType([T.StructField("id", df.schema[id_col].dataType), T.StructField("text", T.StringType())])

    def run(batches):
        for batch in batches:
            ids = batch.column("ids").to_pylist()
            texts = iter(decode_texts(model_path, [i for i in ids if i is not None]))
            yield pa.RecordBatch.from_arrays([batch.column("id"), pa.array([None if i is None else next(texts) for i in ids], pa.string())],
                                             names=["id", "text"])

    return (df.select(F.col(id_col).alias("id"), F.col(ids_col).alias("ids"))
            .mapInArrow(run, schema).withColumnRenamed("id", id_col))
