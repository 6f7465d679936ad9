"""Secrets in whole texts by a linear-chain conditional random field (operator 3).

Fixed patterns give the base spans (``assign``, ``access``, ``hex``).  A
conditional random field tags every white-space-delimited token as the begin,
the inside or the outside of a secret, from the token's shape, its neighbouring
words and features of its file, decoded by Viterbi; tagged stretches that touch
no base span are added as kind ``crf``.

The field is fitted on windows of at most ``MAX_TRAIN_DOCS`` documents (a
documented bound; picked by a hash of the id) with the base spans as labels,
and on generated examples of formats the patterns don't know (bearer tokens,
key blocks, prefixed keys).  Scanning is a map over whole texts: no shuffle.
"""

from __future__ import annotations

import hashlib
import math
import random
import re
from collections import Counter
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tessera.llm.crf import BEGIN, INSIDE, OUTSIDE, LinearChain
from tessera.llm.labelled import free_name
from tessera.llm.text_blocks import no_cycle_search, release_memory, split_words, text_blocks

MAX_TRAIN_DOCS = 6000
WINDOW = 6
N_FEATURES = 4096
KINDS = ("assign", "access", "hex", "crf")

#: The base patterns (letters of the first in either case) and their least lengths.
ASSIGN = re.compile(rb"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.I)
ACCESS = re.compile(rb"AKIA[A-Z0-9]+")
HEX = re.compile(rb"[0-9a-f]{24,}")
MIN_ASSIGN, MIN_ACCESS, MIN_HEX = 6, 20, 24
_ASSIGN_WORDS = (b"password", b"passwd", b"secret", b"token", b"apikey", b"api_key")
_HEX_DIGITS = bytes(120 if chr(c) in "0123456789abcdef" else 32 for c in range(256))

#: Words that announce a secret, and how tokens of key blocks begin.
KEY_WORDS = ("password passwd passphrase pwd secret token apikey api_key key auth authorization bearer credential "
             "credentials private access begin").split()
_PLAIN = r"^[\p{L}'’]{1,24}[.,!?;:)]*$"
_WORD = re.compile(r"[^\x20\x09-\x0D]+")
_RUN = re.compile(r"[A-Za-z0-9+/_=.-]+")
_TRIM = "\"'`.,;:!?()[]{}<>|*$%&#…«»¡¿“”„‘’"


def base_spans(text: str) -> list[tuple[str, int, int]]:
    """Base spans by start, then kind; positions count code points.

    Every code point outside ASCII becomes one byte that no pattern matches, so
    byte positions are code point positions.
    """
    raw = text.encode("ascii", "replace")
    found = []
    low = raw.lower()
    if any(w in low for w in _ASSIGN_WORDS):
        found += [("assign", m.start(), m.end()) for m in ASSIGN.finditer(raw) if len(m[2]) >= MIN_ASSIGN]
    if b"AKIA" in raw:
        found += [("access", m.start(), m.end()) for m in ACCESS.finditer(raw) if m.end() - m.start() >= MIN_ACCESS]
    if b"x" * MIN_HEX in raw.translate(_HEX_DIGITS):
        found += [("hex", m.start(), m.end()) for m in HEX.finditer(raw)]
    return sorted(found, key=lambda s: (s[1], KINDS.index(s[0])))


def joined(spans: list[tuple[str, int, int]]) -> str:
    return ",".join(f"{k}:{a}:{b}" for k, a, b in spans)


def _hashed(names: list[str]) -> list[int]:
    return sorted({int.from_bytes(hashlib.blake2b(n.encode(), digest_size=4).digest(), "big") % N_FEATURES
                   for n in names})


def _bucket(x: float, edges: tuple) -> int:
    return sum(x >= e for e in edges)


def own_features(word: str) -> list[str]:
    """Shape of a token."""
    core = word.strip(_TRIM)
    run = max(_RUN.findall(core), key=len, default="")
    n = max(len(run), 1)
    count = Counter(run)
    entropy = -sum(c / n * math.log2(c / n) for c in count.values())
    classes = re.sub(r"[a-z]+", "a", re.sub(r"[A-Z]+", "A", re.sub(r"[0-9]+", "0", re.sub(r"[^A-Za-z0-9]+", "-", run))))
    digits = sum(c.isdigit() for c in run) / n
    low = word.lower()
    size = _bucket(len(run), (4, 8, 12, 16, 20, 28, 40))
    kind = "".join(c for c, p in (("a", "[a-z]"), ("A", "[A-Z]"), ("0", "[0-9]"), ("-", "[+/_=.-]")) if re.search(p, run))
    out = ["odd", f"size{size}", f"kind{kind}", f"size{size}kind{kind}", f"entropy{_bucket(entropy, (1.5, 2.5, 3, 3.5, 4, 4.5))}",
           f"digits{_bucket(digits, (0.01, 0.15, 0.3, 0.6, 0.99))}", f"turns{_bucket(len(classes), (2, 4, 8, 14))}",
           f"size{size}turns{_bucket(len(classes), (2, 4, 8, 14))}"]
    if len(run) >= 12:
        out.append("begin" + run[:4])
    if re.fullmatch(r"[0-9a-fA-F]+", run):
        out.append(f"hex{size}")
    out += [t for t, p in (("url", "://"), ("mail", "@"), ("set", "="), ("colon", ":"), ("dashes", "-----"), ("quote", '"')) if p in low]
    if any(k in low for k in KEY_WORDS):
        out.append("names a secret")
    return out


def plain_features(size: int) -> list[str]:
    return ["plain", f"plain{size}"]


def neighbour(word: str) -> str:
    """What a token is to its neighbours: a word that announces a secret, or any other."""
    core = word.lower().strip(_TRIM + "=-_")
    return "key " + core if core in KEY_WORDS else "set" if word.strip("!\"'") in ("=", ":", ":=", "=>") else "other"


def file_features(n_words: int, n_odd: int, n_key: int) -> list[str]:
    share = n_odd / max(n_words, 1)
    return [f"file odd{_bucket(share, (0.02, 0.1, 0.3, 0.6))}", f"file key{min(n_key, 2)}"]


@dataclass
class SecretModel:
    """Scores of the states by feature, summed per distinct word when a block is scanned."""

    chain: LinearChain

    def _score(self, names: list[str]) -> np.ndarray:
        return self.chain.weights[_hashed(names)].sum(0)

    def states(self, text: pa.Array):
        """Words of a block and the best state of each."""
        words = split_words(text)
        vocab = words.vocab
        n = len(vocab)
        plain = np.asarray(pc.match_substring_regex(vocab, _PLAIN).to_numpy(zero_copy_only=False), bool)
        size = np.minimum(pc.utf8_length(vocab).to_numpy(zero_copy_only=False) // 4, 6).astype(np.int64)
        by_size = np.stack([self._score(plain_features(k)) for k in range(7)])
        own = by_size[size] if n else np.zeros((0, 3))
        cache: dict[str, np.ndarray] = {}
        around = {p: self._score([f"{p} other"]) for p in ("prev", "prev2", "next")}
        prev, prev2, nxt = (np.tile(around[p], (n, 1)) for p in ("prev", "prev2", "next"))
        odd = ~plain
        low = pc.utf8_trim(pc.utf8_lower(vocab), characters=_TRIM + "=-_")
        key = np.asarray(pc.is_in(low, value_set=pa.array(KEY_WORDS, low.type)).to_numpy(zero_copy_only=False), bool)
        for i in np.flatnonzero(odd | key).tolist():
            w = vocab[i].as_py()
            if odd[i]:
                own[i] = self._score(own_features(w))
            what = neighbour(w)
            if what != "other":
                for table, p in ((prev, "prev"), (prev2, "prev2"), (nxt, "next")):
                    name = f"{p} {what}"
                    if name not in cache:
                        cache[name] = self._score([name])
                    table[i] = cache[name]
        ids, starts = words.ids, words.starts
        e = own[ids]
        edge = {p: self._score([f"{p} none"]) for p in ("prev", "prev2", "next")}
        doc = words.text_of()
        place = np.arange(len(ids))
        first, last = starts[:-1][doc], starts[1:][doc] - 1
        for table, p, shift in ((prev, "prev", -1), (prev2, "prev2", -2), (nxt, "next", 1)):
            at = place + shift
            inside = (at >= first) & (at <= last)
            e += np.where(inside[:, None], table[ids[np.clip(at, 0, max(len(ids) - 1, 0))]], edge[p][None])
        n_words = np.diff(starts)
        n_odd = np.bincount(doc, odd[ids], len(n_words)) if len(ids) else np.zeros(len(n_words))
        n_key = np.bincount(doc, key[ids], len(n_words)) if len(ids) else np.zeros(len(n_words))
        by_file: dict[tuple, np.ndarray] = {}
        files = np.zeros((len(n_words), 3))
        for d, names in enumerate(map(file_features, n_words.tolist(), n_odd.tolist(), n_key.tolist())):
            k = tuple(names)
            files[d] = by_file[k] if k in by_file else by_file.setdefault(k, self._score(names))
        return words, self.chain.decode(e + files[doc], starts)

    def spans(self, text: pa.Array) -> list[tuple[list, list]]:
        """Base spans and all spans of every text."""
        words, states = self.states(text)
        tagged = np.flatnonzero(states != OUTSIDE)
        docs = words.text_of()[tagged]
        out = []
        for d, t in enumerate(text.to_pylist()):
            base = base_spans(t)
            mine = tagged[docs == d] if len(tagged) else tagged
            extra = self._stretches(t, (mine - words.starts[d]).tolist(), states[mine].tolist()) if len(mine) else []
            extra = [s for s in extra if not any(a < s[2] and s[1] < b for _, a, b in base)]
            out.append((base, sorted(base + extra, key=lambda s: (s[1], KINDS.index(s[0])))))
        return out

    @staticmethod
    def _stretches(text: str, at: list[int], states: list[int]) -> list[tuple[str, int, int]]:
        places = [(m.start(), m.end()) for m in _WORD.finditer(text)]
        found: list[tuple[int, int]] = []
        for k, (i, s) in enumerate(zip(at, states, strict=True)):
            a, b = places[i]
            if s == INSIDE and k and at[k - 1] == i - 1:
                found[-1] = (found[-1][0], b)
            else:
                found.append((a, b))
        out = []
        for a, b in found:
            core = text[a:b].strip(_TRIM)
            if core:
                lead = text[a:b].index(core)
                out.append(("crf", a + lead, a + lead + len(core)))
        return out


def _examples(text: str, rng_key: str) -> list[tuple[list[str], list[int], tuple[int, int, int]]]:
    """Windows of a text with the states that the base spans give: around the spans, and one elsewhere."""
    places = [(m.start(), m.end()) for m in _WORD.finditer(text)]
    words = [text[a:b] for a, b in places]
    states = [OUTSIDE] * len(words)
    starts = np.array([a for a, _ in places] + [len(text) + 1])
    centres = []
    for kind, a, b in base_spans(text):
        value = max(_RUN.finditer(text, a, b), key=lambda m: m.end())  # an assignment's value is its last run
        i = int(np.searchsorted(starts, value.start(), side="right")) - 1
        j = int(np.searchsorted(starts, value.end() - 1, side="right")) - 1
        for k in range(i, min(j, len(words) - 1) + 1):
            if states[k] == OUTSIDE:
                states[k] = BEGIN if k == i else INSIDE
        centres.append(i)
    rng = random.Random(rng_key)
    odd = [i for i, w in enumerate(words) if not re.match(r"^[^\W\d_]{1,24}[.,!?;:)]*$", w)]
    centres = centres[:2] + ([rng.choice(odd)] if odd else []) + ([rng.randrange(len(words))] if words else [])
    n_key = sum(w.lower().strip(_TRIM + "=-_") in KEY_WORDS for w in words)
    out = []
    for c in centres:
        lo, hi = max(0, c - WINDOW), min(len(words), c + WINDOW + 1)
        out.append((words[lo:hi], states[lo:hi], (len(words), len(odd), n_key)))
    return out


def generated_examples(n: int = 240, seed: int = 5) -> list[tuple[list[str], list[int], tuple[int, int, int]]]:
    """Secrets in formats that the base patterns don't know, among plain words and harmless odd tokens."""
    rng = random.Random(seed)
    letters = "abcdefghijklmnopqrstuvwxyz"
    b64 = letters + letters.upper() + "0123456789+/"

    def run(alphabet, n):
        return "".join(rng.choice(alphabet) for _ in range(n))

    def filler():
        return rng.choice([run(letters, rng.randint(1, 12)), run(letters, 5).capitalize() + ".", str(rng.randint(1, 10 ** 9)),
                           f"{run(letters, 4)}.{rng.randint(1, 99)}@mail.example.com", f"https://{run(letters, 8)}.org/{run(letters, 4)}",
                           f"192.0.2.{rng.randint(1, 250)}", f"{run(letters, 4).upper()}!!", "|", f"{run(letters, 6)}###"])

    out = []
    for k in range(n):
        left, right = ([filler() for _ in range(rng.randint(2, 5))] for _ in range(2))
        kind = k % 6
        if kind == 0:
            secret, lead = [f"eyJ{run(b64[:62], 20)}.{run(b64[:62], 40)}.{run(b64[:62], 30)}"], ["Authorization:", "Bearer"]
        elif kind == 1:
            secret = [rng.choice(("ghp_", "sk_live_", "xoxb-", "glpat-")) + run(b64[:62], rng.randint(24, 40))]
            lead = [rng.choice(("key", "auth", "is", "with"))]
        elif kind == 2:
            secret, lead = ['"' + run("0123456789ABCDEF", 40) + rng.choice(('"', '"!!'))], rng.choice([["TOKEN!!", "=!!"], ["SECRET", "="]])
        elif kind == 3:
            secret = ["-----BEGIN", "PRIVATE", "KEY-----", *[run(b64, 64) for _ in range(rng.randint(1, 3))], "-----END", "PRIVATE", "KEY-----"]
            lead = []
        elif kind == 4:
            secret, lead = [run(b64, rng.randint(20, 44)) + "="], [rng.choice(("passphrase", "credential", "pwd")), rng.choice(("is", "=", ":"))]
        else:
            secret, lead = [], []
        states = [OUTSIDE] * (len(left) + len(lead)) + [BEGIN] * bool(secret) + [INSIDE] * (len(secret) - 1) + [OUTSIDE] * len(right)
        out.append((left + lead + secret + right, states, (rng.randint(20, 2000), 12, rng.randint(0, 2))))
    return out


def token_features(words: list[str], file: tuple[int, int, int]) -> list[list[int]]:
    """Feature numbers of every token of a window."""
    around = ["none", "none", *map(neighbour, words), "none"]
    out = []
    for i, w in enumerate(words):
        own = plain_features(min(len(w) // 4, 6)) if re.fullmatch(r"[^\W\d_]{1,24}[.,!?;:)]*", w.replace("'", "").replace("’", "")) else own_features(w)
        out.append(_hashed([*own, f"prev {around[i + 1]}", f"prev2 {around[i]}", f"next {around[i + 3]}", *file_features(*file)]))
    return out


def fit_secrets(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", max_docs: int = MAX_TRAIN_DOCS,
                max_with: int = 1000, max_without: int = 3000) -> SecretModel:
    """Fit on windows of at most ``max_docs`` documents, and on generated examples (alone, if there are no documents).

    Of the windows at most ``max_with`` hold a secret and ``max_without`` hold none, both
    picked by a hash of the document's id and the words.  Only the fit is bounded: every text is scanned whole.
    """
    ids = docs.where(F.col(id_col).isNotNull()).select(F.col(id_col).alias("id")).distinct()
    picked = ids.orderBy(F.xxhash64("id", F.lit(3)), "id").limit(max_docs)

    def run(batches):
        for block in text_blocks(batches, "text"):
            rows = [(str(i), *x) for i, t in zip(block.column("id").to_pylist(), block.column("text").to_pylist(), strict=True)
                    for x in _examples(t, str(i))]
            yield pa.RecordBatch.from_arrays(
                [pa.array([r[0] for r in rows], pa.string()), pa.array([r[1] for r in rows], pa.list_(pa.string())),
                 pa.array([r[2] for r in rows], pa.list_(pa.int32())), pa.array([list(r[3]) for r in rows], pa.list_(pa.int32()))],
                names=["id", "words", "states", "file"])

    rows = (docs.select(F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("text"))
            .join(F.broadcast(picked), "id")  # max_docs ids
            .mapInArrow(run, "id string, words array<string>, states array<int>, file array<int>").collect())
    rows = sorted((hashlib.sha256(f"{r.id} {' '.join(r.words)}".encode()).digest(), list(r.words), list(r.states), tuple(r.file)) for r in rows)
    with_secret = [r[1:] for r in rows if any(r[2])]
    without = [r[1:] for r in rows if not any(r[2])]
    examples = with_secret[:max_with] + without[:max_without] + generated_examples()
    chain = LinearChain(N_FEATURES).fit([token_features(w, f) for w, _, f in examples], [s for _, s, _ in examples])
    del rows, with_secret, without, examples
    release_memory()  # the driver goes on with the model alone
    return SecretModel(chain)


def scan_secrets(df: DataFrame, model: SecretModel, keep: list[str], text_col: str = "text",
                 mark: str | None = None) -> DataFrame:
    """The columns ``keep`` of every input row, ``n_assign``, ``n_access``, ``n_hex``, ``base_sha256`` and ``spans``.

    Null texts are scanned as empty ones: no spans, and the hash of an empty
    list.  Columns of ``keep`` called like a new one are replaced.  An empty
    table gives no rows.  With ``mark``, every span is replaced by it in the kept
    ``text_col`` (overlapping spans together; a null text stays null).
    """
    new = ["n_assign", "n_access", "n_hex", "base_sha256", "spans"]
    keep = [c for c in keep if c not in new]
    kept_text = keep.index(text_col) if mark is not None and text_col in keep else None
    scanned, missing = free_name("text to scan", df.columns), free_name("no text", df.columns)
    rows = df.select(*[F.col(f"`{c}`") for c in keep if c != text_col or kept_text is None],
                     F.col(f"`{text_col}`").cast("string").alias(scanned), F.col(f"`{text_col}`").isNull().alias(missing))
    schema = T.StructType([*(df.schema[c] for c in keep), *(T.StructField(c, T.LongType()) for c in new[:3]),
                           *(T.StructField(c, T.StringType()) for c in new[3:])])

    def run(batches):
        for block in text_blocks(batches, scanned):
            text = block.column(scanned)
            with no_cycle_search():
                found = model.spans(text)
            kept = list(block.columns[:-2])
            if kept_text is not None:
                texts = [t if not every else redacted(t, every, mark) for t, (_, every) in zip(text.to_pylist(), found, strict=True)]
                texts = pc.if_else(block.column(missing), pa.scalar(None, pa.string()), pa.array(texts, pa.string()))
                kept.insert(kept_text, texts)
            counts = [[sum(s[0] == k for s in base) for base, _ in found] for k in KINDS[:3]]
            yield pa.RecordBatch.from_arrays(
                [*kept, *(pa.array(c, pa.int64()) for c in counts),
                 pa.array([hashlib.sha256(joined(base).encode()).hexdigest() for base, _ in found], pa.string()),
                 pa.array([joined(every) for _, every in found], pa.string())], names=[*keep, *new])

    return rows.mapInArrow(run, schema)


def redacted(text: str, spans: list[tuple[str, int, int]], mark: str) -> str:
    """``text`` with ``mark`` in the place of every span, or of spans that overlap."""
    merged: list[list[int]] = []
    for a, b in sorted(s[1:] for s in spans):
        if merged and a < merged[-1][1]:
            merged[-1][1] = max(b, merged[-1][1])
        else:
            merged.append([a, b])
    out, at = [], 0
    for a, b in merged:
        out += [text[at:a], mark]
        at = b
    return "".join([*out, text[at:]])
