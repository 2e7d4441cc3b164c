"""Null ids and texts, empty and very long texts, ties, repeated rows, clashing names, empty tables."""

import random
import tracemalloc

import pytest
from pyspark.sql import functions as F

from cardfeat.llm import decontaminate, html_text, language, line_dedup, mixing, quality_classifier, quality_rules, secrets, simhash, token_files
from cardfeat.llm.queries import TOKENIZER
from cardfeat.sources.sinks import scratch_path
from tests.llm import brute


def by_row(found, *columns):
    return sorted(((r["doc_id"] is not None, r["doc_id"] or 0, *(r[c] for c in columns)) for r in found.collect()), key=repr)


@pytest.fixture(scope="module")
def items(spark):
    rows = [(1, "a line of ten words that is long enough for all a line of ten"), (None, "without an id"), (2, None), (3, ""), (3, "one"), (4, "ONE")]
    return spark.createDataFrame(rows, "item_id bigint, text string")


def test_secrets(edge_docs, no_docs, edge_rows):
    found = secrets.digest(secrets.secrets(edge_docs))
    assert by_row(found, "n_assign") == sorted(((i is not None, i or 0, len([s for s in brute.base_spans(t) if s[0] == "assign"])) for i, t in edge_rows), key=repr)
    assert secrets.secrets(no_docs).count() == 0
    clean = secrets.redacted(edge_docs)
    assert clean.columns == edge_docs.columns
    assert clean.filter("doc_id IS NULL AND text IS NOT NULL").first()["text"] == "Some text without an id, [SECRET] end."


def test_secret_checksum():
    import zlib

    body = "a1B2c3D4e5F6g7H8i9J0k1L2m3N4o5"
    n, digits = zlib.crc32(body.encode()), ""
    for _ in range(6):
        n, d = divmod(n, 62)
        digits = secrets.BASE62[d] + digits
    good = f"x ghp_{body}{digits} y"
    assert secrets.spans(good) == [("github", 2, 42)]
    assert secrets.spans(good.replace("ghp_a", "ghp_b")) == []
    assert secrets.spans(good.replace("ghp_", "npm_")) == [("npm", 2, 42)]


def test_language(edge_docs, no_docs, edge_rows):
    found = language.identify(edge_docs, F.lit(True))
    got = {(r["doc_id"], r["lang_pred"]) for r in found.collect()}
    assert found.count() == len(edge_rows)
    assert {(1, "und"), (2, "und"), (3, "und"), (9, "und"), (None, "und"), (4, "en"), (5, "en")} <= got
    assert {r["lang_pred"] for r in language.identify(edge_docs, F.lit(False)).collect()} == {"und"}
    assert language.identify(no_docs, F.lit(True)).count() == 0


def test_line_dedup(edge_docs, no_docs):
    found = line_dedup.delete_repeated_lines(edge_docs)
    got = {(r["doc_id"], r["n_lines"], r["n_deleted"]) for r in found.collect()}
    assert found.count() == edge_docs.count()
    # the first five lines of document 5 stay, its other lines and all of document 6 repeat them
    assert {(1, 0, 0), (2, 1, 0), (5, 9, 3), (6, 9, 8)} <= got or {(1, 0, 0), (2, 1, 0)} <= got
    five = [r for r in found.collect() if r["doc_id"] in (5, 6)]
    assert [(r["doc_id"], r["n_deleted"]) for r in sorted(five, key=lambda r: r["doc_id"])] == [
        (i, n) for i, n in zip((5, 5, 6), _repeats())
    ]
    assert line_dedup.delete_repeated_lines(no_docs).count() == 0


def _repeats():
    line = "A line of ten words that is long enough for all.\n" * 8
    a, b = brute.remaining_lines([(5, line), (6, line)])
    return a[2], a[2], b[2]


def test_line_dedup_extends_along_any_earlier_place(spark):
    common = "\n".join(" ".join(f"{c}{k}" for k in range(30)) for c in "pq")
    x, y = ("\n".join(" ".join(f"{c}{n}{k}" for k in range(10)) for n in range(3)) for c in "xy")
    texts = [common, f"{common}\n{x}", f"{common}\n{x}", f"{common}\n{x}\nend", f"{common}\n{y}", f"{common}\n{x[:x.rindex(chr(10))]}\n{y}"]
    found = line_dedup.delete_repeated_lines(spark.createDataFrame(list(enumerate(texts)), "doc_id bigint, text string")).collect()
    got = {r["doc_id"]: (r["text"], r["n_deleted"]) for r in found}
    assert got == {0: (common, 0), 1: (x, 2), 2: ("", 5), 3: ("end", 5), 4: (y, 2), 5: (y, 4)}


def test_line_dedup_compares_with_all_earlier_places(spark):
    draw = random.Random(5)
    texts = ["\n".join(draw.choice(["a", "b", "c d", ""]) for _ in range(draw.randrange(12))) for _ in range(60)]
    split = [t.split("\n") for t in texts]
    places = []  # document, first line, end, in order
    for k, lines in enumerate(split):
        for a in range(len(lines)):
            b = next((b for b in range(a + 1, len(lines) + 1) if len(" ".join(lines[a:b]).split()) >= 5), None)
            if lines[a] and b:
                places.append((k, a, b))
    gone = [set() for _ in texts]
    for n, (k, a, b) in enumerate(places):
        for k0, a0, b0 in places[:n]:
            if split[k0][a0:b0] != split[k][a:b]:
                continue
            more = 0
            while b + more < len(split[k]) and split[k0][b0 + more : b0 + more + 1] == [split[k][b + more]]:
                more += 1
            gone[k] |= set(range(a, b + more))
    found = line_dedup.delete_repeated_lines(spark.createDataFrame(list(enumerate(texts)), "doc_id bigint, text string"), 5).collect()
    assert {r["doc_id"]: r["n_deleted"] for r in found} == {k: len(g) for k, g in enumerate(gone)}
    assert {r["doc_id"]: r["text"] for r in found} == {k: "\n".join(x for n, x in enumerate(split[k]) if n not in g) for k, g in enumerate(gone)}


def test_simhash(edge_docs, no_docs, edge_rows):
    found = simhash.simhash_classes(edge_docs)
    assert by_row(found, "fingerprint") == sorted(((i is not None, i or 0, f"{brute.fingerprint(t):016x}") for i, t in edge_rows), key=repr)
    zero = [r for r in found.collect() if r["fingerprint"] == "0" * 16]
    assert len(zero) == 4 and {r["component_id"] for r in zero} == {1}
    assert simhash.simhash_classes(no_docs).count() == 0


def test_one_document_of_each_component_stays(edge_docs, no_docs):
    kept = simhash.drop_near_copies(edge_docs)
    assert kept.columns == edge_docs.columns
    ids = [r["doc_id"] for r in kept.collect()]
    assert sorted(i or 0 for i in ids) == [0, 1, 4, 5, 7, 8, 9]
    assert simhash.drop_near_copies(no_docs).count() == 0


def test_token_files(spark, edge_docs, no_docs, edge_rows):
    path = scratch_path(spark, "edge-tokens")
    token_files.write_tokens(edge_docs, path, TOKENIZER)
    got = sorted(map(tuple, token_files.token_digests(token_files.read_tokens(spark, path)).collect()), key=lambda r: r[1])
    assert [r[0] for r in got] == sorted((i for i, _ in edge_rows), key=lambda i: (i is not None, i))
    one = {(i, n, c) for i, _, n, c in brute.token_places(edge_rows)}
    assert {(i, n, c) for i, _, n, c in got} == one
    assert all(b[1] == a[1] + a[2] for a, b in zip(got, got[1:])) and got[0][1] == 0
    path = scratch_path(spark, "no-tokens")
    token_files.write_tokens(no_docs, path, TOKENIZER)
    assert token_files.read_tokens(spark, path).count() == 0


def test_decontaminate(spark, edge_docs, no_docs, edge_rows, items, monkeypatch):
    want = brute.contamination(edge_rows, [tuple(r) for r in items.collect()])
    for limit in (decontaminate.BLOCK_WORDS, 3):  # several blocks give the same
        monkeypatch.setattr(decontaminate, "BLOCK_WORDS", limit)
        for r in decontaminate.contamination(edge_docs, items).collect():
            if r["doc_id"] is not None:
                n = want[r["doc_id"]]
                assert (r["n_words"], r["n_hit"], len(r["items"]), r["contaminated"]) == (n[0], n[1], n[2], n[4])
    kept = decontaminate.remove_contaminated(edge_docs, items)
    assert kept.columns == edge_docs.columns
    assert sorted(r["doc_id"] or 0 for r in kept.collect()) == sorted(i or 0 for i, t in edge_rows if not (want[i][4] and i is not None) and t != "Some text without an id, password=abcdefghij0123456789 end.")
    assert decontaminate.remove_contaminated(edge_docs, items.limit(0)).count() == len(edge_rows)
    assert decontaminate.contamination(no_docs, items).count() == 0


def test_long_items_take_memory_in_proportion():
    text = " ".join(f"w{k}" for k in range(6_000))
    tracemalloc.start()
    items = decontaminate.read_items(["1", "2"], [text, "x " + text])
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert len(items.starts) == 6_000 - 12 + 1 and peak < 40 << 20
    assert items.owners[0] == ["1", "2"] and items.places[0] == [("1", 0), ("2", 1)]


def test_long_items_are_cut_without_loss(spark, monkeypatch):
    words = [f"W{k}" for k in range(100)]
    docs = [(a, " ".join(words[a : a + 13])) for a in range(88)] + [(100, " ".join(words[50:62])), (101, ", ".join(words).lower())]
    docs = spark.createDataFrame(docs, "doc_id bigint, text string")
    items = spark.createDataFrame([(7, "; ".join(words)), (8, "W3 w4")], "item_id bigint, text string")
    want = sorted(map(tuple, decontaminate.contamination(docs, items).collect()))
    monkeypatch.setattr(decontaminate, "BLOCK_WORDS", 30)
    sizes = [b.depth for b in decontaminate._blocks(items, "item_id", "text")]
    assert len(sizes) > 2 and max(sizes) <= 42
    assert sorted(map(tuple, decontaminate.contamination(docs, items).collect())) == want
    assert [r[2] for r in want if r[0] == 100] == [0]


@pytest.mark.parametrize("count", [1, 5, 400])
def test_longest_match_of_each_document(spark, monkeypatch, count):
    """Ties, repeats and unknown words; few items and more suffixes than a shard has words."""
    draw = random.Random(count)

    def some(most, words="abc"):
        return " ".join(draw.choice(words) for _ in range(draw.randrange(most)))

    benchmark = [(draw.randrange(5) or None, some(40)) for _ in range(count)]
    known = " ".join(t for _, t in benchmark)
    texts = [(None, None), (-1, "")] + [(k, some(60, "abcd") + " " + known[draw.randrange(1 + len(known)) :][:80]) for k in range(30)]
    docs, items = spark.createDataFrame(texts, "doc_id bigint, text string"), spark.createDataFrame(benchmark, "item_id bigint, text string")
    want = sorted(((i, *brute.longest_match(t, benchmark)) for i, t in texts), key=repr)

    def found():
        rows = decontaminate.contamination(docs, items, longest=True).collect()
        return sorted(((r["doc_id"], *(r["longest"] or (0, None, None, None))) for r in rows), key=repr)

    assert found() == want
    monkeypatch.setattr(decontaminate, "BLOCK_WORDS", 40)  # several blocks of whole items
    if count < 400:  # a block is a job over all documents
        assert found() == want


def test_places_in_a_cut_item_count_from_its_start(spark, monkeypatch):
    words = [f"w{k}" for k in range(100)]
    docs = spark.createDataFrame([(1, "x y " + " ".join(words[65:82]))], "doc_id bigint, text string")
    items = spark.createDataFrame([(7, " ".join(words))], "item_id bigint, text string")
    monkeypatch.setattr(decontaminate, "BLOCK_WORDS", 30)
    assert tuple(decontaminate.contamination(docs, items, longest=True).head()["longest"]) == (17, "7", 65, 2)


def test_longest_matches(spark):
    words = [f"w{k}" for k in range(40)]
    docs = [(1, " ".join(words[5:25])), (2, "x " + " ".join(words[3:20])), (3, "nothing here")]
    docs = spark.createDataFrame(docs, "doc_id bigint, text string")
    items = spark.createDataFrame([(7, " ".join(words))], "item_id bigint, text string")
    got = {tuple(r) for r in decontaminate.longest_matches(docs, items).collect()}
    want = set()
    for p in range(40):
        places = [(1, p - 5, 25 - p) for _ in (0,) if 5 <= p < 25] + [(2, p - 2, 20 - p) for _ in (0,) if 3 <= p < 20]
        places = [x for x in places if x[2] >= 13 and 40 - p >= 13]
        best = max((x[2] for x in places), default=0)
        want |= {("7", p, n, d, at) for d, at, n in places if n == best}
    assert got == want


def test_quality_rules(edge_docs, no_docs, edge_rows, edge_labels, no_labels):
    names = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")
    for labels in (edge_labels, no_labels):
        found = quality_rules.quality_rules(edge_docs, labels)
        assert by_row(found, *names) == sorted(((i is not None, i or 0, *brute.counts(t)) for i, t in edge_rows), key=repr)
        kept = quality_rules.drop_rejected(edge_docs, labels)
        assert kept.columns == edge_docs.columns
        assert kept.count() == found.filter("kept").count()
    assert quality_rules.quality_rules(no_docs, edge_labels).count() == 0


def test_quality_classifier(edge_docs, no_docs, edge_labels, no_labels, edge_rows):
    for labels in (edge_labels, no_labels):
        found = quality_classifier.quality_scores(edge_docs, labels, F.lit(True)).collect()
        assert len(found) == len(edge_rows) and all(0 <= r["score"] <= 1 for r in found)
    assert {r["score"] for r in found} == {0.5}
    assert quality_classifier.quality_scores(no_docs, edge_labels, F.lit(True)).count() == 0


def test_mixing(edge_docs, no_docs, edge_labels, no_labels, edge_rows):
    for labels in (edge_labels, no_labels):
        found = mixing.mix_rates(edge_docs, labels).collect()
        assert len(found) == len(edge_rows) and all(r["rate"] >= 0 for r in found)
        kept = mixing.sample_mix(edge_docs, labels)
        assert kept.columns == edge_docs.columns
        assert kept.count() == sum(r["copies"] > 0 for r in found)
    assert {r["domain"] for r in found} == {"clean"} and kept.count() == len(edge_rows)
    assert mixing.mix_rates(no_docs, edge_labels).count() == 0
    assert mixing.sample_mix(no_docs, edge_labels).count() == 0


def test_rows_of_one_id_do_not_fill_the_sample(spark, monkeypatch):
    monkeypatch.setattr(mixing, "SAMPLE", 400)
    rows = [(1, f"text {k}") for k in range(4_000)] + [(2, "always the same")] * 4_000 + [(k, f"other {k}") for k in range(3, 203)]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string")
    labels = spark.createDataFrame([(k, k % 2, 0) for k in range(1, 203)], "doc_id bigint, quality int, toxic int")
    sample = mixing.label_sample(docs, labels, mixing.label_domain()).collect()
    assert 200 <= len(sample) <= 500 and {r["_value"] for r in sample} == {0, 1}
    assert sorted(mixing.label_sample(docs.repartition(3), labels, mixing.label_domain()).collect()) == sorted(sample)


def test_rows_without_id_do_not_fill_the_language_sample(spark, monkeypatch):
    monkeypatch.setattr(language, "SAMPLE", 40)
    rows = [(None, f"text {k:05}", "en") for k in range(4_000)] + [(None, "ever alike", "en")] * 4_000 + [(k, f"andere {k}", "de") for k in range(30)]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, lang string").repartition(4)
    seen = []
    to_pandas = type(docs).toPandas

    def counted(frame):
        seen.append(to_pandas(frame))
        return seen[-1]

    monkeypatch.setattr(type(docs), "toPandas", counted)
    # the mark that all rows of one length share may or may not be in the sample, so several lengths are tried
    for more in range(60):
        language._sample(docs.withColumn("text", F.concat("text", F.lit("x" * more))), F.lit(True))
        if len(seen[-1]) > 30:
            break
    assert 30 < len(seen[-1]) <= 30 + 2 * 44


def test_html(spark):
    page = "<html><body><nav>Menu</nav><article><h1>T</h1><p>Tom &amp; Jerry\n run.<p>x<div class=ad>Buy</div></article></body></html>"
    rows = [(1, "u", page), (2, None, None), (None, "v", ""), (1, "u", page), (3, "w", "<p>" + "long text, more. " * 100_000)]
    pages = spark.createDataFrame([(*r, 7, 8) for r in rows], "page_id bigint, url string, html string, text int, n_chars int")
    found = sorted(map(tuple, html_text.extract(pages).collect()), key=repr)
    assert found[:2] == [(1, "u", "T\nTom & Jerry run.\nx", 20)] * 2
    assert (2, None, "", 0) in found and (None, "v", "", 0) in found
    assert {r[3] for r in found if r[0] == 3} == {17 * 100_000 - 1}
    assert html_text.extract(pages.limit(0)).count() == 0
