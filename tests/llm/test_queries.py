"""Every registered query on texts over its whole tables, against brute force."""

import re
import zlib

import pytest

from cardfeat.llm.queries import QUERIES
from tests.conftest import SMALL
from tests.llm import brute


@pytest.fixture(scope="module")
def docs():
    return sorted(brute.table(SMALL, "documents", "doc_id, text"))


def rows(spark, name):
    found = [tuple(r) for r in QUERIES[name](spark, SMALL).collect()]
    assert len({r[0] for r in found}) == len(found)
    return {r[0]: r[1:] for r in found}


def test_secrets(spark, docs):
    got = rows(spark, "op1_secrets")
    assert len(got) == len(docs)
    for i, text in docs:
        base = brute.base_spans(text)
        n = [sum(s[0] == kind for s in base) for kind in ("assign", "access", "hex")]
        joined = ",".join(f"{k}:{a}:{b}" for k, a, b in base)
        assert got[i][:4] == (*n, brute.sha(joined))
        assert [s for s in got[i][4].split(",") if s.split(":")[0] in ("assign", "access", "hex")] == [s for s in joined.split(",") if s]


def test_language(spark):
    got = rows(spark, "op2_language")
    known = brute.table(SMALL, "documents", "doc_id, lang")
    assert len(got) == len(known)
    assert all(got[i][0] == (zlib.crc32(str(i).encode()) % 4 == 2) and 0 <= got[i][2] <= 1 for i, _ in known)
    held = [got[i][1] == lang for i, lang in known if got[i][0]]
    assert sum(held) >= 0.95 * len(held)


def test_line_dedup(spark, docs):
    got = rows(spark, "op3_line_dedup")
    assert got == {i: r for (i, _), r in zip(docs, brute.remaining_lines(docs))}


def test_simhash(spark, docs):
    got = rows(spark, "op4_simhash")
    prints = [brute.fingerprint(t) for _, t in docs]
    label = brute.components(prints)
    least = {}
    for (i, _), c in zip(docs, label):
        least[c] = min(least.get(c, i), i)
    assert got == {i: (f"{p:016x}", least[c]) for (i, _), p, c in zip(docs, prints, label)}


def test_token_files(spark, docs):
    assert sorted((i, *r) for i, r in rows(spark, "op5_token_files").items()) == brute.token_places(docs)


def test_decontaminate(spark, docs):
    got = rows(spark, "op6_decontaminate")
    items = brute.table(SMALL, "benchmark", "item_id, text")
    assert {i: r[:5] for i, r in got.items()} == brute.contamination(docs, items)
    assert {i: r[5:] for i, r in got.items()} == {i: brute.longest_match(t, items) for i, t in docs}


def test_quality_rules(spark, docs):
    got = rows(spark, "op7_quality_rules")
    for i, text in docs:
        n = brute.counts(text)
        failed = n[0] < 50 or 100 * n[4] > 50 * n[0]
        assert got[i][:6] == (*n, failed)
        assert got[i][6] == (not failed and got[i][7] >= -0.08)


def test_quality_classifier(spark):
    got = rows(spark, "op8_quality_classifier")
    labels = brute.table(SMALL, "labels", "doc_id, quality")
    assert all(s[0] == (zlib.crc32(str(i).encode()) % 5 == 0) and 0 <= s[1] <= 1 and s[2] == (s[1] >= 0.3) for i, s in got.items())
    held = [(got[i][1], q) for i, q in labels if i in got and got[i][0]]
    good, bad = [s for s, q in held if q == 1], [s for s, q in held if q == 0]
    if good and bad:
        assert sum(g > b for g in good for b in bad) >= 0.9 * len(good) * len(bad)


def test_mixing(spark, docs):
    found = QUERIES["op9_mixing"](spark, SMALL).toPandas()
    assert len(found) == len(docs)
    assert (found[["p_clean", "p_poor", "p_toxic"]].sum(axis=1) - 1).abs().max() < 1e-6
    words = {i: len(brute.SPACED.findall(t or "")) for i, t in docs}
    assert all(words[i] == n for i, n in zip(found.doc_id, found.n_tokens))
    assert (found.rate >= 0).all() and ((found.copies - found.rate).abs() < 1).all()
    supply = {d: (found.n_tokens * found[f"p_{d}"]).sum() for d in ("clean", "poor", "toxic")}
    got = {d: (found.rate * found.n_tokens * found[f"p_{d}"]).sum() for d in supply}
    want = {"clean": 1.05 * supply["clean"]}
    want |= {d: min(w / 0.9 * want["clean"], supply[d]) for d, w in (("poor", 0.07), ("toxic", 0.03))}
    assert all(abs(got[d] - want[d]) <= 1e-3 * sum(supply.values()) for d in supply)


def test_html_text(spark):
    got = rows(spark, "op10_html_text")
    for i, url, page in brute.table(SMALL, "pages", "page_id, url, html"):
        article = re.search("<article>(.*?)(?:</article>|$)", page or "", re.S)
        import html

        blocks = [re.sub(r"\s+", " ", html.unescape(re.sub(r"</?b>", "", b).replace("<br>", " "))).strip() for b in re.split(r"</?(?:p|h1)>", article[1])]
        text = "\n".join(b for b in blocks if b)
        assert got[i] == (url, text, len(text))
