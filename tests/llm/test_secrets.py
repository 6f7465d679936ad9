import hashlib
import random
import re

import numpy as np
import pytest
from pyspark.sql import types as T

from tessera.llm import crf, secrets

HEX40 = "9b0b3c6a43eb78aa99cbd7049c572391524f37a8"


def plain_base(text):
    """The base spans straight from their definition."""
    out = []
    for m in re.finditer(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""",
                         text, re.I | re.A):
        if len(m[2]) >= 6:
            out.append(("assign", m.start(), m.end()))
    out += [("access", m.start(), m.end()) for m in re.finditer("AKIA[A-Z0-9]+", text) if len(m[0]) >= 20]
    out += [("hex", m.start(), m.end()) for m in re.finditer("[0-9a-f]+", text) if len(m[0]) >= 24]
    return sorted(out, key=lambda s: (s[1], secrets.KINDS.index(s[0])))


def test_base_spans_match_definition():
    rng = random.Random(2)
    pieces = ["token", "TOKEN", "Secret", "api_key", "apiKey", "passwd", " ", "=", ":", '"', "'", "é", "ſecret", "K",
              "AKIA", "ABCDEFGH01234567", HEX40[:23], HEX40[:24], HEX40, "hunter2hunter2", "==", "x-y_z/1", "\n", "日"]
    for _ in range(3000):
        text = "".join(rng.choice(pieces) for _ in range(rng.randint(0, 14)))
        assert secrets.base_spans(text) == plain_base(text), text


def test_viterbi_with_certain_tokens_equals_full_search():
    rng = np.random.default_rng(4)
    chain = crf.LinearChain(1, moves=rng.normal(size=(3, 3)))
    for _ in range(200):
        e = rng.normal(size=(rng.integers(1, 12), 3)) * 3
        e[:, 0] += rng.normal() * 4
        assert chain.decode(e, np.array([0, len(e)])).tolist() == chain.viterbi(e)


def test_gradient_of_the_likelihood():
    """A fitted chain gives the labelled states of separable sequences, moves included."""
    tokens = [[[0], [1], [1], [0]], [[0], [0]], [[1], [0], [1]]] * 5
    states = [[0, 1, 2, 0], [0, 0], [1, 0, 1]] * 5
    chain = crf.LinearChain(2).fit(tokens, states, steps=150)
    for seq, want in zip(tokens, states, strict=True):
        assert chain.viterbi(np.stack([chain.weights[x].sum(0) for x in seq])) == want


@pytest.fixture(scope="module")
def model(spark):
    rng = random.Random(1)
    words = ["river", "stone", "walks", "1999", "a.b@mail.example.com", "green."]
    docs = []
    for i in range(120):
        w = [rng.choice(words) for _ in range(40)]
        if i % 2:
            w[20:20] = ["token", "=", '"' + "".join(rng.choice("0123456789abcdef") for _ in range(40)) + '"']
        docs.append((i, " ".join(w)))
    return secrets.fit_secrets(spark.createDataFrame(docs, "doc_id long, text string"))


def test_scan_adds_spans_and_keeps_base(spark, model):
    jwt = "eyJ" + "aB3dE5gH7j" * 2 + "." + "Zk9Qw8Er7T" * 4 + "." + "p0OiU9yT6r" * 3
    long = "river stone " * 30_000 + f'password: "{HEX40}" green'
    texts = [f"walks with Authorization: Bearer {jwt} river.", "river stone walks green. 1999", None, "", long,
             f"é日 token = {HEX40}", "again river", "again river"]
    schema = T.StructType([T.StructField("doc_id", T.LongType()), T.StructField("text", T.StringType()),
                           T.StructField("spans", T.StringType())])
    df = spark.createDataFrame([(i if i else None, t, "clash") for i, t in enumerate(texts)], schema)
    got = {r.doc_id: r for r in secrets.scan_secrets(df, model, ["doc_id", "text", "spans"]).collect()}
    assert len(got) == len(texts)
    for i, t in enumerate(texts):
        r, base = got[i if i else None], plain_base(t or "")
        assert r.text == t
        assert (r.n_assign, r.n_access, r.n_hex) == tuple(sum(s[0] == k for s in base) for k in secrets.KINDS[:3])
        assert r.base_sha256 == hashlib.sha256(secrets.joined(base).encode()).hexdigest()
        assert set(secrets.joined(base).split(",")) <= set(r.spans.split(",")) or not base
    at = texts[0].index(jwt)
    assert got[None].spans == f"crf:{at}:{at + len(jwt)}"
    assert all(got[i].spans == "" for i in (1, 2, 3, 6, 7))
    assert secrets.scan_secrets(df.limit(0), model, ["doc_id"]).count() == 0


def test_redaction(spark, model):
    assert secrets.redacted("abcdefgh", [("assign", 1, 4), ("hex", 2, 5), ("crf", 6, 7)], "*") == "a*f*h"
    rows = [(1, f"é token = {HEX40} x", "s"), (2, "river stone", "s"), (3, None, "s"), (4, "", "s")]
    df = spark.createDataFrame(rows, "doc_id long, text string, source string")
    out = secrets.scan_secrets(df, model, ["doc_id", "text", "source"], mark="[SECRET]").orderBy("doc_id").collect()
    assert [tuple(r)[:3] for r in out] == [(1, "é [SECRET] x", "s"), (2, "river stone", "s"), (3, None, "s"), (4, "", "s")]
    assert out[0].n_assign == out[0].n_hex == 1


def test_fit_without_documents(spark):
    empty = spark.createDataFrame([], "doc_id long, text string")
    assert secrets.fit_secrets(empty).chain.weights.any()


def test_fit_gives_its_memory_back(spark, monkeypatch):
    calls = []
    monkeypatch.setattr(secrets, "release_memory", lambda: calls.append("released"))
    secrets.fit_secrets(spark.createDataFrame([], "doc_id long, text string"))
    assert calls == ["released"]
