from __future__ import annotations

import hashlib
import random
import re

from hypothesis import given, settings
from hypothesis import strategies as st

from quitanda.llm import secrets

PLAIN = {"hex": r"[0-9a-f]+"}
LEAST = {"assign": 6, "access": 20, "hex": 24}


def brute(text, base_only=False):
    """Spans by Python's regex over the whole text; the base rules as they are written."""
    out = []
    for number, rule in enumerate(secrets.RULES[:3] if base_only else secrets.RULES):
        for m in re.finditer(PLAIN.get(rule.kind, rule.regex), text or ""):
            if len(m.group(rule.group)) >= LEAST.get(rule.kind, 1):
                out.append((m.start(), number, m.end(), rule.kind))
    return ",".join(f"{k}:{a}:{b}" for a, _, b, k in sorted(out))


def check(df):
    texts = {}
    for r in df.select("doc_id", "text").collect():
        texts.setdefault(r.doc_id, []).append(r.text)
    got = {}
    for r in secrets.digest(secrets.scan(df)).collect():
        got.setdefault(r.doc_id, []).append((r.n_assign, r.n_access, r.n_hex, r.base_sha256, r.spans))
    expected = {}
    for d, own in texts.items():
        for t in own:
            base = brute(t, True)
            n = [sum(x.startswith(k) for x in base.split(",")) for k in ("assign", "access", "hex")]
            expected.setdefault(d, []).append((*n, hashlib.sha256(base.encode()).hexdigest(), brute(t)))
    assert {d: sorted(x) for d, x in got.items()} == {d: sorted(x) for d, x in expected.items()}
    return got


def test_documents_match_brute_force(spark):
    got = check(spark.read.parquet("/root/testdata/sf0.01/documents.parquet"))
    assert sum(r[0] for own in got.values() for r in own) > 0


def test_made_up_secrets(spark):
    h40 = "0123456789abcdef" * 2 + "01234567"
    rows = [(1, f'x TOKEN = "{h40}" secret:token: abcdefgh Passwd=\'zz9/+._-==\''),
            (2, "AKIA" + "A" * 15 + " AKIA" + "B" * 16 + "c AKIAAKIA" + "0" * 12), (3, "api_key  :  abcdef api-key=abcdef apikey:abcdef"),
            (4, "é𝒳 password=日本 password=abcdefg é " + h40 + "g" + "f" * 23 + " " + "f" * 24), (5, "token=token=token=abcdef"),
            (6, "-----BEGIN RSA PRIVATE KEY----- ghp_" + "a" * 36 + " xoxb-0123456789-ab AIza" + "x" * 35),
            (7, "eyJabcdefgh0.eyJabcdefgh0.sig_sig-sig sk_live_" + "Z" * 20), (8, "pas ass ssw swo wor ord but not the word"),
            (9, "password\n=abcdef password\x20\x20=\x20abcdef"), (10, "x" * 200000 + " secret=" + "q" * 9)]
    got = check(spark.createDataFrame(rows, "doc_id long, text string"))
    assert got[8] == [(0, 0, 0, hashlib.sha256(b"").hexdigest(), "")]
    assert "github" in got[6][0][4] and "jwt" in got[7][0][4]


@given(st.lists(st.lists(st.sampled_from(["token", "Secret", "api_key", "=", ":", " ", '"', "'", "abc", "0123456789abcdef", "AKIA",
                                          "ABCDEFGHIJKLMNOP", "é", "\n", ".", "=="]), max_size=14).map("".join), min_size=1, max_size=20))
@settings(max_examples=10, deadline=None)
def test_random_texts(spark, texts):
    check(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string"))


def test_trigram_queries():
    query = {r.kind: secrets.trigram_query(r.regex) for r in secrets.RULES}
    assert query["hex"] == [] and query["access"] == [frozenset({"aki", "kia"})]
    assert frozenset({"tok", "oke", "ken"}) in query["assign"] and len(query["assign"]) == 6
    assert {"ghp", "hp_"} in [set(c) for c in query["github"]]
    # every match holds a clause of its rule
    rng = random.Random(2)
    for text in ("Api_Key: abcdef", "AKIA" + "X" * 20, "xoxp-1234567890", "rk_live_" + "a" * 16):
        for rule in secrets.RULES:
            if re.search(rule.regex, text) and query[rule.kind]:
                assert any(all(t in text.lower() for t in c) for c in query[rule.kind]), (rule, text, rng)


def test_very_many_matches_in_one_text(spark):
    """40 000 spans of one text are placed in time n log n (each was copied for every later one before)."""
    text = " ".join(f"é token={i:08d}" for i in range(40_000))
    check(spark.createDataFrame([(1, text), (2, "token=abcdefgh")], "doc_id long, text string"))


def test_running_sums(spark):
    for n in (0, 1, 2, 3, 7, 8, 9, 100):
        df = spark.createDataFrame([(list(range(5, 5 + n)),)], "a array<long>")
        want = [sum(range(5, 5 + i + 1)) for i in range(n)]
        assert df.select(secrets.running_sums(df["a"]).alias("s")).first().s == want


def test_awkward_rows(awkward, clashing, empty_docs):
    check(awkward)
    check(clashing)
    assert secrets.digest(secrets.scan(empty_docs)).collect() == []
