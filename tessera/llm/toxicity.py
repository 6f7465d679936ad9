"""Toxicity scores of whole texts (operator 1).

Gradient-boosted trees over dense features of a text: densities of lexicon
words (a short fixed list, and words and word beginnings learnt from the
labelled rows), lexicon words near a second-person word, capitals,
punctuation and obfuscation rates; then isotonic calibration on labelled rows
that the trees have not seen.

The fit reads at most ``MAX_PER_CLASS`` labelled rows of each class (a
documented bound; rows are picked by a hash of their id and weighted to the
class sizes).  Scoring is a map over whole texts: no shuffle.
"""

from __future__ import annotations

import re
from collections import Counter
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tessera.llm.boosting import BoostedTrees, Isotonic, calibrated
from tessera.llm.labelled import class_sample
from tessera.llm.text_blocks import split_words, sums_by_text, text_blocks

MAX_PER_CLASS = 6000
MAX_CANDIDATES = 20_000
MAX_TERMS = 800
PREFIXES = (3, 4, 5, 6, 7)
NEAR_WORDS = 5

#: Common insults.
INSULTS = ("asshole bastard bitch clown cretin dickhead disgusting dumb dumbass filth freak fucker garbage idiot "
           "imbecile jerk loser moron pathetic retard scum shit stupid trash vermin whore worthless").split()
#: Second-person words (English, German, French, Spanish).
SECOND_PERSON = ("you your yours yourself u ur du dich dir dein deine deinem deinen deiner ihr euch euer tu te toi ton "
                 "ta tes vous votre vos tú ti tuyo tus usted ustedes vosotros").split()
#: Characters written for letters.
LOOKALIKES = str.maketrans("0134578@$!|", "oieastbasil")

_TRIM = ".,!?;:\"'()[]{}<>|*$%&#_-…«»¡¿“”„‘’`~^+=/\\"
_HIDDEN = r"\p{L}[0-9@$!|*._\-]+\p{L}"
_LONG = "|".join(f"{c}{{3,}}" for c in "abcdefghijklmnopqrstuvwxyz")
N_FEATURES = 18


@dataclass
class Lexicon:
    """Weights of words and of word beginnings by their length."""

    words: dict[str, float] = field(default_factory=dict)
    prefixes: dict[int, dict[str, float]] = field(default_factory=dict)


def _weights(values: pa.Array, weights: dict[str, float]) -> np.ndarray:
    if not weights:
        return np.zeros(len(values))
    at = pc.index_in(values, value_set=pa.array(list(weights), values.type))
    table = np.array([*weights.values(), 0.0])
    return table[pc.fill_null(at, len(weights)).to_numpy(zero_copy_only=False)]


def _count(values: pa.Array, pattern: str) -> np.ndarray:
    return pc.count_substring_regex(values, pattern).to_numpy(zero_copy_only=False).astype(np.float64)


def _plain(word: str) -> str:
    """A word without its disguise: look-alikes as letters, fillers and repeated letters dropped."""
    word = re.sub(r"[*._\-]", "", word.translate(LOOKALIKES))
    return re.sub(r"(.)\1{2,}", r"\1", word)


def features(text: pa.Array, lexicon: Lexicon) -> np.ndarray:
    """One row of ``N_FEATURES`` numbers per text; an empty text gives zeros."""
    words = split_words(text)
    vocab, ids, starts = words.vocab, words.ids, words.starts
    lower = pc.utf8_trim(pc.utf8_lower(vocab), characters=_TRIM)
    hidden = np.asarray(pc.match_substring_regex(vocab, _HIDDEN).to_numpy(zero_copy_only=False), bool)
    drawn = np.asarray(pc.match_substring_regex(lower, _LONG).to_numpy(zero_copy_only=False), bool)
    word = _weights(lower, lexicon.words)
    begin = np.zeros(len(vocab))
    for k, table in lexicon.prefixes.items():
        begin = np.maximum(begin, _weights(pc.utf8_slice_codeunits(lower, 0, k), table))
    insult = _weights(lower, dict.fromkeys(INSULTS, 1.0))
    unmasked = np.zeros(len(vocab))
    for i in np.flatnonzero(hidden | drawn):
        w = _plain(lower[i].as_py())
        unmasked[i] = max(w in INSULTS, lexicon.words.get(w, 0.0) > 0)
    letters, upper = _count(vocab, r"\p{L}"), _count(vocab, r"\p{Lu}")
    marks, digits = _count(vocab, r"[!?]"), _count(vocab, r"[0-9]")
    chars = pc.utf8_length(vocab).to_numpy(zero_copy_only=False).astype(np.float64)
    other = chars - letters - marks - digits

    def total(per_word):
        return sums_by_text(per_word[ids], starts)

    n = np.maximum(np.diff(starts), 1).astype(np.float64)
    n_letters, n_chars = np.maximum(total(letters), 1), np.maximum(total(chars), 1)
    hit = (np.maximum(np.maximum(word, begin), np.maximum(insult, unmasked)) > 0)[ids]
    at, person = np.flatnonzero(hit), np.flatnonzero((_weights(lower, dict.fromkeys(SECOND_PERSON, 1.0)) > 0)[ids])
    near = np.zeros(len(ids))
    if len(at) and len(person):
        doc = words.text_of()
        right = np.searchsorted(person, at)
        for side in (np.minimum(right, len(person) - 1), np.maximum(right - 1, 0)):
            close = (np.abs(person[side] - at) <= NEAR_WORDS) & (doc[person[side]] == doc[at])
            near[at[close]] = 1.0
    strongest = np.zeros(len(n))
    np.maximum.at(strongest, words.text_of()[at], np.maximum(word, begin)[ids][at])
    hits_word, hits_begin, hits_insult = total((word > 0) * 1.0), total((begin > 0) * 1.0), total(insult)
    hits_near = sums_by_text(near, starts)
    return np.stack([
        np.log1p(hits_word), total(word) / n, np.log1p(hits_begin), total(begin) / n, strongest,
        np.log1p(hits_insult), hits_insult / n, total(unmasked), hits_near / n, np.log1p(hits_near),
        total(upper) / n_letters, total(((upper > 1) & (upper == letters)) * 1.0) / n, total(marks) / n_chars,
        total(other) / n_chars, total(hidden * 1.0) / n, total(drawn * 1.0) / n, total(digits) / n_chars,
        np.log1p(np.diff(starts)),
    ], 1)


def _terms(text: pa.Array, lexicon_only: set[str] | None = None) -> list[set[str]]:
    """Words (``w`` before) and word beginnings (their length before) of every text, once each."""
    words = split_words(text)
    lower = pc.utf8_trim(pc.utf8_lower(words.vocab), characters=_TRIM).to_pylist()
    own = [[t for t in ["w" + w, *(f"{k}{w[:k]}" for k in PREFIXES if len(w) > k)]
            if lexicon_only is None or t in lexicon_only] if w else [] for w in lower]
    out = []
    for i in range(len(words.starts) - 1):
        out.append({t for j in np.unique(words.ids[words.starts[i]:words.starts[i + 1]]).tolist() for t in own[j]})
    return out


def learn_lexicon(sample: DataFrame, max_terms: int = MAX_TERMS) -> Lexicon:
    """Terms that set the positive texts of ``sample`` (``text``, ``y``, ``w``) apart.

    Candidates are the terms of at least three positive texts; their numbers of
    negative texts are counted in a second pass.
    """

    def counts(only):
        def run(batches):
            for block in text_blocks(batches, "text"):
                n = Counter(t for terms in _terms(block.column("text"), only) for t in terms)
                yield pa.RecordBatch.from_arrays([pa.array(n.keys(), pa.string()), pa.array(n.values(), pa.int64())],
                                                 names=["term", "n"])
        return run

    def collected(rows, only, least):
        found = (rows.select("text").mapInArrow(counts(only), "term string, n long").groupBy("term")
                 .agg(F.sum("n").alias("n")).where(F.col("n") >= least)
                 .orderBy(F.desc("n"), "term").limit(MAX_CANDIDATES).collect())
        return {r.term: r.n for r in found}

    sizes = {r.y: (r.n, r.w) for r in sample.groupBy("y").agg(F.count("*").alias("n"), F.sum("w").alias("w")).collect()}
    if len(sizes) < 2:
        return Lexicon()
    n_pos, n_neg = sizes[1.0][0], sizes[0.0][0]
    pos = collected(sample.where("y = 1"), None, 3)
    neg = collected(sample.where("y = 0"), set(pos), 1)
    odds = {t: np.log((n + 0.5) / (n_pos + 1)) - np.log((neg.get(t, 0) + 0.5) / (n_neg + 1)) for t, n in pos.items()}
    best = sorted((t for t in pos if odds[t] > 1.5), key=lambda t: (-odds[t] * np.sqrt(pos[t]), t))[:max_terms]
    out = Lexicon()
    for t in best:
        (out.words if t[0] == "w" else out.prefixes.setdefault(int(t[0]), {}))[t[1:]] = float(odds[t])
    return out


@dataclass
class ToxicityModel:
    lexicon: Lexicon
    trees: BoostedTrees
    isotonic: Isotonic

    def score(self, text: pa.Array) -> np.ndarray:
        return calibrated(self.trees.raw(features(text, self.lexicon)), self.isotonic)


def fit_toxicity(docs: DataFrame, labels: DataFrame, label_col: str = "toxic", id_col: str = "doc_id",
                 text_col: str = "text", max_per_class: int = MAX_PER_CLASS) -> ToxicityModel:
    """Fit on at most ``max_per_class`` labelled rows of each class.

    Three quarters of them fit the lexicon and the trees, the rest the
    calibration.  Without labelled rows of both classes the score is the share
    of positives (0 without any).
    """
    picked = class_sample(labels, label_col, max_per_class, id_col)
    sample = (docs.select(F.col(id_col).alias("id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))
              .join(F.broadcast(picked), "id")  # at most two classes of max_per_class ids
              .withColumn("fit", F.pmod(F.xxhash64("id", F.lit(1)), F.lit(4)) > 0)
              .repartition(16, "id").persist())
    lexicon = learn_lexicon(sample.where("fit"))

    def run(batches):
        for block in text_blocks(batches, "text"):
            x = features(block.column("text"), lexicon)
            yield pa.RecordBatch.from_arrays(
                [pa.array(list(x), pa.list_(pa.float64())), block.column("y"), block.column("w"), block.column("fit")],
                names=["x", "y", "w", "fit"])

    rows = sample.select("text", "y", "w", "fit").mapInArrow(
        run, "x array<double>, y double, w double, fit boolean").toPandas()
    sample.unpersist()
    y, w = rows["y"].to_numpy(), rows["w"].to_numpy()
    if len(set(y)) < 2:
        share = float(y.mean()) if len(y) else 0.0
        return ToxicityModel(lexicon, BoostedTrees(), Isotonic(np.zeros(1), np.full(1, share)))
    x, fit = np.stack(rows["x"].to_numpy()), rows["fit"].to_numpy(dtype=bool)
    order = np.lexsort((*x.T, y))  # the same order whichever task came first
    x, y, w, fit = x[order], y[order], w[order], fit[order]
    if len(set(y[fit])) < 2 or len(set(y[~fit])) < 2:
        fit = np.ones(len(y), bool)
    trees = BoostedTrees().fit(x[fit], y[fit], w[fit])
    held = ~fit if (~fit).any() else fit
    return ToxicityModel(lexicon, trees, Isotonic().fit(trees.raw(x[held]), y[held], w[held]))
