"""Pieces of the operators by themselves."""

import random

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from cardfeat.llm import components as components_module
from cardfeat.llm import html_text, language, mixing, rans, simhash
from cardfeat.llm.components import components
from cardfeat.llm.flat import SPACED, flat, slices, words
from cardfeat.llm.queries import TOKENIZER
from cardfeat.llm.quality_classifier import isotonic
from cardfeat.llm.tokens import Encoder
from tests.llm import brute


def test_words_of_sliced_columns():
    texts = ["a b", None, "", " c\n", "d" * 50, "e f g"]
    column = pa.array(["skipped x y", *texts]).slice(1)
    for limit in (1, 10, 1 << 20):
        got = []
        for _, part in slices(column, limit):
            w = words(part, SPACED)
            got += [bytes(part.data[a:b]).decode() for a, b in zip(w.starts, w.ends)]
        assert got == [x for t in texts for x in brute.SPACED.findall(t or "")]
    assert len(flat(column)) == len(texts)


def test_pieces_encode_like_whole_texts():
    e = Encoder(TOKENIZER)
    random.seed(3)
    texts = ["", "don't 'll we'll", "x<|endoftext|>y  <|endoftext|> z", "日本 語　a", "a b \x85c", "\x1c a", "\r\n x"]
    texts += ["".join(random.choice(" \n\tab.,'é1A!×ñ”  ") for _ in range(random.randint(0, 20))) for _ in range(2000)]
    ids, offsets = [], [0]
    for _, i, o in e.encode_column(pa.array(texts)):
        offsets += (o[1:] + len(np.concatenate(ids) if ids else [])).tolist()
        ids.append(i)
    ids = np.concatenate(ids)
    for k, want in enumerate(e.tokenizer.encode_batch(texts, add_special_tokens=False)):
        assert ids[offsets[k] : offsets[k + 1]].tolist() == want.ids, texts[k]


def test_forgotten_pieces_are_learnt_again(monkeypatch):
    monkeypatch.setattr("cardfeat.llm.tokens.REMEMBERED", 5)
    e = Encoder(TOKENIZER)
    for texts in (["a b c d e f"], ["a b x y z"], ["a b c q r s t u"], ["a b"]):
        for _, ids, _ in e.encode_column(pa.array(texts)):
            assert ids.tolist() == e.tokenizer.encode(texts[0], add_special_tokens=False).ids


@pytest.mark.parametrize("n", [0, 1, 63, 64, 5000, 300_000])
def test_range_coding_round_trip(n):
    ids = np.minimum((np.random.default_rng(n).pareto(0.8, n) * 4).astype(np.int64), 50_256)
    table = rans.table(np.bincount(ids, minlength=65_536))
    raw = rans.encode([5, None], [n // 3, n - n // 3], ids, rans.Table.from_bytes(table.to_bytes()))
    block, got = rans.decode(raw, table)
    assert (got == ids).all() and block.docs == [5, None] and block.sizes.tolist() == [n // 3, n - n // 3]
    for k in range(len(block.points)):  # any segment alone
        step = block.every * block.lanes
        assert (rans.decode_segment(block, k, table) == ids[k * step : (k + 1) * step]).all()
    if n:
        with pytest.raises(rans.CorruptBlock):
            rans.decode(raw[:-9] + bytes([raw[-9] ^ 1]) + raw[-8:], table)


def test_tile_links_connect_what_brute_force_connects():
    rng = np.random.default_rng(1)
    base = rng.integers(0, 1 << 63, 60, dtype=np.uint64)
    prints = np.unique(np.concatenate([base ^ (np.uint64(1) << rng.integers(0, 64, 60).astype(np.uint64)) for _ in range(6)]))
    u, v = simhash.tile_links(prints, prints, 4, True)
    place = {int(p): k for k, p in enumerate(prints)}
    label = simhash.forest(np.array([place[int(x)] for x in u]), np.array([place[int(x)] for x in v]), len(prints))
    want = brute.components([int(p) for p in prints])
    assert len(u) < len(prints)
    assert len(set(zip(label.tolist(), want))) == len(set(want)) == len(set(label.tolist()))


def test_tiles_are_skipped_only_without_links(spark, monkeypatch):
    monkeypatch.setattr(simhash, "MIN_TILE", 8)
    monkeypatch.setattr(simhash, "TILES", 10**6)
    rng = np.random.default_rng(2)
    base = rng.integers(0, 1 << 63, 40, dtype=np.uint64)
    flips = [base] + [base ^ (np.uint64(3) << rng.integers(0, 60, 40).astype(np.uint64)) for _ in range(4)]
    prints = np.unique(np.concatenate(flips))
    table = spark.createDataFrame([(int(p), k) for k, p in enumerate(prints.view(np.int64))], "fp bigint, id bigint")
    got = {r["fp"]: r["component_id"] for r in simhash.classes(table).collect()}
    label = brute.components([int(p) for p in prints])
    least = {}
    for k, c in enumerate(label):
        least.setdefault(c, k)
    assert got == {int(p): least[c] for p, c in zip(prints.view(np.int64), label)}


@pytest.mark.parametrize("squares", [1, 20, 10**6])
def test_squares_of_tiles_hold_all_pairs(spark, monkeypatch, squares):
    monkeypatch.setattr(simhash, "MIN_TILE", 8)
    monkeypatch.setattr(simhash, "TILES", 10**6)
    monkeypatch.setattr(simhash, "SQUARES", squares)
    rng = np.random.default_rng(5)
    prints = np.unique(rng.integers(0, 1 << 63, 300, dtype=np.uint64) & np.uint64(0xFFF000F))
    table = spark.createDataFrame([(int(p),) for p in prints.view(np.int64)], "fp bigint")
    tiles = simhash._tiles(table, 4)
    pairs = simhash._pairs(tiles, 4)
    cells = simhash._cells(tiles, pairs).collect()
    listed = [(p["a"], p["b"]) for r in {(r["row"], r["column"]): r["pairs"] for r in cells}.values() for p in r]
    assert sorted(listed) == sorted(map(tuple, pairs.collect()))
    if squares == 1:  # a tile travels once for each row of squares, of which there are two
        assert len(cells) <= 2 * tiles.count() < len(listed) / 3
    if squares > len(listed):
        assert len({(r["row"], r["column"]) for r in cells}) == len(listed)
    least = {}
    label = brute.components([int(p) for p in prints])
    for k, c in enumerate(label):
        least.setdefault(c, k)
    got = {r["fp"]: r["component_id"] for r in simhash.classes(table.withColumn("id", F.monotonically_increasing_id() * 0 + F.col("fp"))).collect()}
    smallest = {}
    for k, c in enumerate(label):
        smallest[c] = min(smallest.get(c, 1 << 62), int(prints.view(np.int64)[k]))
    assert got == {int(p): smallest[c] for p, c in zip(prints.view(np.int64), label)}


def test_no_step_is_taken_that_makes_a_mix_worse(monkeypatch):
    """Totals that get worse whatever the step: the rates and totals of the start are returned, together."""
    start, asked = np.array([100.0, 50.0, 20.0]), []

    def fake(rows, steps, domains):
        asked.append(steps.copy())
        return start * (1 + 10 * np.abs(steps).sum()) if np.abs(steps).sum() else start, np.eye(domains) * 50

    monkeypatch.setattr(mixing, "_totals", fake)
    mix = mixing.fit_mix(None, None, [0.9, 0.07, 0.03])
    assert (mix.steps == 0).all() and (mix.totals == start).all() and len(asked) == 1 + mixing.HALVINGS


def test_totals_belong_to_the_steps_they_are_returned_with(monkeypatch):
    start = np.array([100.0, 50.0, 20.0])

    def totals(steps):
        return start * (1 - np.tanh(3 * steps))

    monkeypatch.setattr(mixing, "_totals", lambda rows, steps, domains: (totals(steps), np.diag(start)))
    mix = mixing.fit_mix(None, None, [0.9, 0.07, 0.03])
    assert mix.totals == pytest.approx(totals(mix.steps))
    assert np.abs(mix.totals - mix.targets).sum() < np.abs(start - mix.targets).sum()


def test_components_of_a_long_chain(spark):
    chain = [(k, k + 1) for k in range(0, 60)] + [(100, 101), (7, 7), (101, 100)]
    got = {tuple(r) for r in components(spark.createDataFrame(chain, "u bigint, v bigint")).collect()}
    assert got == {(k, 0) for k in range(1, 61)} | {(101, 100)}


@pytest.mark.parametrize("hot_rows", [2, 50_000])
def test_components_with_hubs(spark, monkeypatch, hot_rows):
    """Stars with many leaves, joined by one link; hubs go their own way."""
    monkeypatch.setattr(components_module, "HOT_ROWS", hot_rows)
    links = [(0, k) for k in range(1, 40)] + [(100, k) for k in range(101, 140)] + [(39, 139), (500, 501)]
    got = {tuple(r) for r in components(spark.createDataFrame(links, "u bigint, v bigint")).collect()}
    assert got == {(k, 0) for k in [*range(1, 40), *range(100, 140)]} | {(501, 500)}


def test_tables_over_byte_pairs_give_the_same_network():
    net = language.Network.fresh(["a", "b", "c"])
    rng = np.random.default_rng(0)
    x = rng.integers(0, 256, (5, language.WINDOW + 4)).astype(np.uint8)
    pooled = []
    for w in language.WIDTHS:
        sums = sum(net.embed[x[:, j : j + language.WINDOW]] @ net.taps[w][j] for j in range(w))
        pooled.append(sums.max(axis=1) + net.bias[w])
    logits = np.maximum(np.concatenate(pooled, axis=1), 0) @ net.out + net.out_bias
    want = np.exp(logits) / np.exp(logits).sum(axis=1, keepdims=True)
    assert np.allclose(language.Predictor(net).windows(x), want, atol=1e-5)


def test_gradients_of_the_network():
    net = language.Network.fresh(["a", "b"])
    rng = np.random.default_rng(4)
    x = rng.integers(0, 256, (6, language.WINDOW + 4)).astype(np.uint8)
    y = rng.integers(0, 2, 6)

    def loss():
        return -np.log(language.Predictor(net).windows(x)[np.arange(6), y]).mean()

    for weights, slopes in zip(net.parameters(), language._gradients(net, x, y)):
        at = np.unravel_index(np.abs(slopes).argmax(), slopes.shape)
        before = weights[at]
        weights[at] = before + 1e-3
        up = loss()
        weights[at] = before - 1e-3
        assert abs((up - loss()) / 2e-3 - slopes[at]) < 2e-2 * max(1e-2, abs(slopes[at])) + 1e-4
        weights[at] = before


def test_isotonic():
    got = isotonic(np.array([0, 1, 0, 1.0]), np.array([1, 1, 1, 1.0]), 0.5)
    assert np.allclose(got, [0.25, 0.5, 0.5, 0.75])


def test_pages_without_article_marks():
    page = """<body><div id=top><a href=/>Home</a> <a href=/x>About us</a></div><div class="layout has-sidebar"><div class=text>
    <h1>Title here</h1><p>Long paragraph, with words; and more. Yes it is long enough to count.</p><p>Short.</p>
    <ul><li>One item<li>Two item</ul><blockquote>q &amp; a</blockquote></div><div class="sidebar"><p>Popular posts, many of them.
    Read more, please.</p></div></div><div id=comments><p>Nice post, I like it, really. Thanks a lot for that.</p></div>
    <form><p>Mail, please: it is a long text, with marks.</p></form><script>var a="<p>no</p>";</script><div>(c) 2020 Foo</div>"""
    want = ["Title here", "Long paragraph, with words; and more. Yes it is long enough to count.", "Short.", "One item", "Two item", "q & a"]
    assert html_text.main_blocks(page) == want


def test_article_without_text_gives_nothing():
    assert html_text.main_text("<nav>Menu</nav><article><h1></h1><p><br></article><div>Some other text, here.</div>") == ""


def test_blocks_of_links_are_left_out():
    page = "<html><body><h1>Hello</h1><p>Some text, here it is.</p><p>More, <a href=x>here</a>.</p><hr><p><a href=a>Home</a> | <a href=b>Next</a></p>"
    assert html_text.main_blocks(page) == ["Hello", "Some text, here it is.", "More, here."]


def test_an_article_inside_a_named_layout_is_the_main_part():
    page = """<body><div class="content-with-menu"><ul class="menu"><li>Home</li></ul><article><p>Body.</p></article></div>
    <div class="related"><article><p>Other</p></article></div><section id="comments"><article><p>Nice</p></article></section></body>"""
    assert html_text.main_blocks(page) == ["Body."]


STORY = [f"Paragraph {k} of the story, with words; and more. It is long enough to count, as you can see, and goes on, and on, for a while." for k in "abcd"]
_STORY_HTML = "".join(f"<p>{p}</p>" for p in STORY)


def test_a_marked_teaser_does_not_replace_a_story_in_plain_boxes():
    page = f"""<body><div class=text><h1>Title</h1>{_STORY_HTML}</div>
    <div class=more><article><h3>Other</h3><p>Read this as well.</p></article></div></body>"""
    assert html_text.main_blocks(page) == ["Title", *STORY]
    assert html_text.main_blocks(page.replace("<article>", "<div role=article>").replace("</article>", "</div>")) == ["Title", *STORY]


def test_boxes_inside_an_article_are_judged_by_ratio():
    page = f"""<body><div class=latest><div>Other</div></div><article><h1>Title</h1><div class=body>{_STORY_HTML}<h2><a href=x>Part two</a></h2><p>Short.</p></div>
    <div class=more><div>Get it here</div><div>Print it</div></div></article></body>"""
    assert html_text.main_blocks(page) == ["Title", *STORY, "Part two", "Short."]


def test_long_text_beside_an_article_does_not_replace_it():
    long = "One very long notice, in a box of its own; it goes on, and on. " * 8
    page = f"<body><article><h1>Title</h1>{_STORY_HTML}<p>Short.</p></article><div class=box><div>{long}</div></div></body>"
    assert html_text.main_blocks(page)[:6] == ["Title", *STORY, "Short."]


def test_fitted_rates_solve_the_least_squares_problem(monkeypatch):
    """Against a direct solution over all rates: the nonnegative ones with the least change and residual."""
    rng = np.random.default_rng(11)
    tokens = rng.integers(1, 400, 60).astype(float)
    posterior = rng.dirichlet([0.1, 0.1, 0.1], 60)

    def totals(rows, steps, domains):
        rate = np.maximum(1 - posterior @ steps, 0)
        return posterior.T @ (rate * tokens), (posterior * (tokens * (rate > 0))[:, None]).T @ posterior

    monkeypatch.setattr(mixing, "_totals", totals)
    mix = mixing.fit_mix(None, None, [0.9, 0.07, 0.03])
    ridge = mixing.RIDGE * tokens.sum()
    a = (posterior * tokens[:, None]).T
    free = np.ones(len(tokens), bool)
    for _ in range(100):  # rates that would be negative are held at zero
        left = a[:, free]
        matrix = np.diag(tokens[free]) + left.T @ left / ridge
        found = np.zeros(len(tokens))
        found[free] = np.linalg.solve(matrix, tokens[free] + left.T @ mix.targets / ridge)
        slope = tokens * (found - 1) + a.T @ (a @ found - mix.targets) / ridge
        new = (found > 0) | (~free & (slope < -1e-9))
        if (new == free).all():
            break
        free = new
    assert (found == 0).any() and (found > 1).any()
    assert np.allclose(mix.rates(posterior), found, atol=1e-3)
    assert np.allclose(mix.totals, totals(None, mix.steps, 3)[0])
