from __future__ import annotations

import hashlib
import random
import re
import string

from shopflow.llm import secret_scan as op
from tests.llm.cases import clashing, corpus, frame

ASSIGN = r"""([Pp][Aa][Ss][Ss][Ww][Oo][Rr][Dd]|[Pp][Aa][Ss][Ss][Ww][Dd]|[Ss][Ee][Cc][Rr][Ee][Tt]|[Tt][Oo][Kk][Ee][Nn]|[Aa][Pp][Ii]_?[Kk][Ee][Yy])["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""


def brute(text):
    spans = []
    for kind, pattern, group, least in ((0, ASSIGN, 2, 6), (1, r"AKIA[A-Z0-9]+", 0, 20), (2, r"[0-9a-f]+", 0, 24)):
        spans += [(m.start(), kind, m.end()) for m in re.finditer(pattern, text or "") if len(m[group]) >= least]
    return sorted(spans)


def noise(rng, n):
    bits = ["password", "Token", "api_key", "APIKEY", "secret", " ", "=", ":", '"', "'", "AKIA", "é", "\n", "ſecret", "toKen"]
    bits += ["0123456789abcdef" * 2, "ABCDEFGH12345678", "abc.def", "x", "k9"]
    return "".join(rng.choice(bits) for _ in range(n))


def test_base_spans(spark):
    rng = random.Random(8)
    rows = [(i, noise(rng, rng.randrange(40)), "en", "a", 1) for i in range(300)]
    rows += [(r[0], *r[1:]) for r in corpus()]
    got = op.scan(clashing(spark, rows)).collect()
    assert len(got) == len(rows)
    expected = sorted(
        (
            (r[0], *(sum(k == kind for _, k, _ in brute(r[1])) for kind in range(3)),
             hashlib.sha256(op.written(brute(r[1])).encode()).hexdigest())
            for r in rows
        ),
        key=repr,
    )
    assert sorted(((r.doc_id, r.n_assign, r.n_access, r.n_hex, r.base_sha256) for r in got), key=repr) == expected
    for r in got:  # base spans stay, in order
        spans = [s for s in r.spans.split(",") if s and not s.startswith("novel")]
        assert hashlib.sha256(",".join(spans).encode()).hexdigest() == r.base_sha256


def random_key(rng, n=40):
    return "".join(rng.choice(string.ascii_letters + string.digits) for _ in range(n))


def test_random_strings_are_novel_and_names_are_not():
    rng = random.Random(4)
    known = b"\n".join([b"authentication_handler_v2", b"credential_store_1_default"])
    novelty = op.Novelty(known)
    for _ in range(40):
        text = f"the deploy used bearer {random_key(rng)} for the call"
        assert [op.KINDS[k] for _, k, _ in novelty.spans(text, [])] == ["novel"]
    for text in (
        "auth goes through authentication_handler_v2 here",
        "credential_store_1_default is the credential_store_1_default",
        "auth aaaaaaaaaaaaaaaaaaaaaaaaaaaaaaa1",
        "no sensitive word " + random_key(rng),
        "bearer of longwordswithoutanydigits",
        "bearer " + " " * 60 + random_key(rng),
    ):
        assert novelty.spans(text, []) == []


def test_context_explains_a_repeated_value():
    value = random_key(random.Random(1))
    novelty = op.Novelty(b"")
    text = f"x {value} y bearer {value} z"
    assert novelty.marginal(text, text.rindex(value), text.rindex(value) + 40) < 12


def test_dictionary_counts_identifiers(spark):
    rows = [(i, "alpha_id = 1\nbeta_id(2) gamma_id", "en", "a", 1) for i in range(5)] + [(9, "beta_id: 3", "en", "a", 1)]
    assert op.dictionary(frame(spark, rows)) == b"alpha_id\nbeta_id"
    assert op.dictionary(frame(spark, [])) == b""


def test_redaction(spark):
    key = random_key(random.Random(3))
    rows = [
        (1, 'a token = "abcdef123456" b', "en", "s", 29),
        (2, "clean text", "en", "s", 999),
        (3, None, None, None, None),
        (4, f"bearer {key}!", "en", "s", 1),
    ]
    docs = clashing(spark, rows)
    got = {r.doc_id: r for r in op.redact(docs).collect()}
    assert op.redact(docs).columns == docs.columns
    assert got[1].text == 'a [assign]" b' and got[1].n_chars == len(got[1].text)
    assert (got[2].text, got[2].n_chars, got[3].text, got[3].n_chars) == ("clean text", 999, None, None)
    assert got[4].text == "bearer [novel]!"
    assert op.redact(frame(spark, [])).count() == 0
