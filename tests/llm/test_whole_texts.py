"""Nothing is left out, nothing runs away: whole vocabularies and pages, long and hostile texts, repeated rows, clashing columns."""

import hashlib
import math
import time
import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from quarryframe.llm import decontaminate, hmm, html, language, minhash, packing, quality, queries, sharding, stages, substring
from quarryframe.llm.textkit import Words
from tests.llm.test_text_operators import SCHEMA, brute_passages, corpus, shingles

ARTICLE = "<p>The text of the article.</p>"
WRAPPERS = [
    f'<svg class="logo"/><article>{ARTICLE}</article>',
    f'<div class="content-with-sidebar">{ARTICLE}</div>',
    f'<div class="page-no-sidebar">{ARTICLE}</div>',
    f'<div class="layout-sidebar-right">{ARTICLE}</div>',
    f'<div class="side-by-side">{ARTICLE}</div>',
    f'<div class="elementor-widget elementor-widget-text">{ARTICLE}</div>',
    f'<div class="post-header">{ARTICLE}</div>',
    f'<div class="widget-area"><p>About us</p><article>{ARTICLE}</article></div>',
    f'<div class="topbar wrapper"><main>{ARTICLE}</main></div>',
    f'<div class="rail-2">{ARTICLE}</div>',
    f"<form>{ARTICLE}</form>",
]


def test_articles_in_odd_wrappers(spark):
    side = '<div class="sidebar-with-ads">side</div><div class="related"><article>teaser</article></div>'
    rows = [(i, f"http://{i}.example/", f"<html><body>{w}{side}</body></html>") for i, w in enumerate(WRAPPERS)]
    got = {x.page_id: x.text for x in html.main_text(spark.createDataFrame(rows, "page_id long, url string, html string")).collect()}
    for i, w in enumerate(WRAPPERS):
        assert got[i].split("\n")[0] == "The text of the article.", w


def test_inline_svg_does_not_part_a_block():
    assert [b[0] for b in html.parse("<p>one <svg a='/x'/>two <svg><text>no</text></svg>three</p>")[0]] == ["one two three"]


def test_every_round_of_training_runs_over_all_texts(spark):
    draw = np.random.default_rng(6)
    docs = spark.createDataFrame([(i, " ".join(f"{'ab'[i % 2]}{k}x" for k in draw.zipf(1.5, 40) % 90)) for i in range(80)], "doc_id long, text string")
    vocab, _, model, _, encoded = hmm.fit(hmm.prepared(docs))
    learn = list(hmm.Encoded.parts(iter(encoded.where("not held_out").toArrow().to_batches())))
    want = hmm.Model.first(vocab.class_share)
    for _ in range(hmm.ROUNDS):
        want = want.update(sum(hmm.expected_counts(want, x.classes(vocab), x.lengths) for x in learn), vocab.class_share)
    assert model.start == pytest.approx(want.start, abs=1e-4) and model.move == pytest.approx(want.move, abs=1e-4) and model.emit == pytest.approx(want.emit, abs=1e-5)


def test_states_emit_every_word(spark, monkeypatch):
    """The table has all words, emissions sum to 1, and scores are those of a plain forward recursion, words being joined or not."""
    monkeypatch.setattr(hmm, "HEAVY_WORDS", 7)
    draw = np.random.default_rng(4)
    texts = [" ".join(f"{'ab'[i % 2]}{k}x" for k in draw.zipf(1.5, 60) % 90) + (" unseen" if zlib.crc32(str(i).encode()) % 7 == 2 else "") for i in range(50)] + [""]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    seen = [t for i, t in enumerate(texts) if zlib.crc32(str(i).encode()) % 7 != 2]
    vocab, _, model, table, _ = hmm.fit(hmm.prepared(docs))
    rows = table.collect()
    distinct = {w for t in seen for w in t.split()}
    assert len(rows) == len(distinct) + 1 and len(vocab.words) < len(distinct)
    expected = np.array([[r[x] for x in hmm._S] for r in rows])
    n = np.rint(expected.sum(1))
    assert expected.sum(1) == pytest.approx(n, abs=1e-4) and sorted(n) == sorted([*Counter(w for t in seen for w in t.split()).values(), len(seen)])
    emission = hmm.Emission(expected.sum(0), vocab.total, vocab.distinct)
    unknown = emission(np.zeros(1), np.zeros((1, hmm.STATES)))[0]
    emit = emission(n, expected)
    assert emit.sum(0) + unknown == pytest.approx(np.ones(hmm.STATES))
    at = {r.word: k for k, r in enumerate(rows)}
    key = lambda w: int(Words(pa.array([w])).hashes(lower=True).view(np.int64)[0])
    end = emit[at[int(np.array(hmm._END).view(np.int64))]]
    for r in hmm.lm_scores(docs).collect():
        steps = [emit[at[key(w)]] if key(w) in at else unknown for w in texts[r.doc_id].split()] + [end]
        state = model.start * steps[0]
        log = 0.0
        for e in steps[1:]:
            log, state = log + math.log10(state.sum()), (state / state.sum()) @ model.move * e
        assert r.score == pytest.approx(log + math.log10(state.sum()), abs=1e-3)


def test_languages_of_few_long_texts_are_learnt(spark):
    words = {"aa": "lorem ipsum dolor", "bb": "quick brown foxes", "cc": "zwei kleine katzen", "dd": "petit chat noir"}
    rows = [(100 * k + i, f"{w} {i} " * (100_000 if lang == "aa" else 5), lang) for k, (lang, w) in enumerate(words.items()) for i in range(10)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    learnt = []
    fit = language.LanguageModel.fit
    language.LanguageModel.fit = lambda x, langs: learnt.extend(langs) or fit(x, langs)
    try:
        language.fit(docs)
    finally:
        language.LanguageModel.fit = fit
    assert sorted(learnt) == sorted(r[2] for r in rows)


def test_long_runs_have_the_ids_of_the_tokenizers_library():
    from tokenizers import Tokenizer

    path = queries.tokenizer_path()
    one, other = packing.encoder(path), Tokenizer.from_file(path)
    runs = [" " * 5000, "\n" * 5000, " \t\u00a0\n" * 2000, "a" * 5000, "\u2003" * 3000]
    for run in runs:
        for text in (run, f"one{run}two", f"{run}two", f"one{run}", f"one{run}<|endoftext|>{run}two", f"{run}\u00e9 {run}1{run}'s", f"x{run}." * 3):
            assert one(text).tolist() == other.encode(text, add_special_tokens=False).ids, repr(text[:20])
    for c in " \na":
        assert one(c * 2_000_000).tolist() == other.encode(c * 2_000_000, add_special_tokens=False).ids


def test_rows_that_share_a_doc_id_keep_their_own_text(spark):
    x, y, q = ([f"{c}{i}" for i in range(n)] for c, n in (("x", 80), ("y", 70), ("q", 200)))
    rows = [(1, " ".join(x)), (2, " ".join(x + y)), (2, " ".join(x + q)), (2, " ".join(x + q)), (3, " ".join(q)), (None, " ".join(x))]
    docs = spark.createDataFrame([(i, t, "en", "a", len(t)) for i, t in rows], "doc_id long, text string, lang string, source string, n_chars long")
    got = sorted((r.doc_id or 0, r.n_words, r.n_removed, r.kept_sha256) for r in substring.repeated_passages(docs).collect())
    digest = lambda words: hashlib.sha256(" ".join(words).encode()).hexdigest()
    want = [(0, 80, 0, digest(x)), (1, 80, 0, digest(x)), (2, 150, 80, digest(y)), (2, 280, 80, digest(q)), (2, 280, 80, digest(q)), (3, 200, 200, digest([]))]
    assert got == sorted(want)
    texts = sorted((r.doc_id or 0, r.text, r.n_chars) for r in stages.cut_repeated_passages(spark, docs, "").collect())
    assert [(i, t) for i, t, _ in texts] == sorted((i, " ".join(w)) for i, w in [(0, x), (1, x), (2, y), (2, q), (2, q), (3, [])]) and all(n == len(t) for _, t, n in texts)


def test_repeat_counts_of_a_very_long_text(spark):
    """Four million distinct words have no repeated window; then one, planted far apart."""
    n = 4_000_000
    docs = spark.range(2).select(F.col("id").alias("doc_id"), F.concat_ws(" ", F.transform(F.sequence(F.lit(0), F.lit(n - 1)), lambda i: F.hex(i)), F.when(F.col("id") == 1, F.lit("7 8 9 A x"))).alias("text"))
    docs = docs.withColumns({"lang": F.lit("en"), "source": F.lit("a")})
    assert {r.doc_id: r.n_repeat_words for r in quality.quality_verdicts(docs).collect()} == {0: 0, 1: 8}


def test_an_item_is_found_whatever_else_the_benchmark_holds(spark):
    item = "kilo lima mike november oscar papa quebec romeo sierra. tango uniform victor whiskey"
    question, answer = item.split(". ")
    filler = " ".join(f"f{i}" for i in range(2000))
    docs = spark.createDataFrame([(1, f"{question} {filler} {answer}"), (2, f"{filler} {item} {filler}"), (3, None)], "doc_id long, text string")
    long_item = (2, " ".join(f"z{i}" for i in range(3000)))
    found = [{(r.doc_id, r.item_id) for r in decontaminate.contaminated(docs, spark.createDataFrame(items, "item_id long, text string")).collect()} for items in ([(1, item)], [(1, item), long_item])]
    assert found == [{(2, 1)}] * 2
    whole = spark.createDataFrame([(5, f"a b c {long_item[1]} d e f")], "doc_id long, text string")
    assert decontaminate.contaminated(whole, spark.createDataFrame([long_item, (1, item)], "item_id long, text string")).count() == 1
    nulls = spark.createDataFrame([(None, None)], "item_id long, text string")
    assert decontaminate.contaminated(docs, nulls).count() == 0 and decontaminate.contaminated(spark.createDataFrame([(None, None)], docs.schema), nulls).count() == 0


HOSTILE = ["<a ", "<b '", '<b="', "<!--", "<!", "<script>", '<b x="', '<p class="', "<svg", "&#" + "9" * 5000 + ";", "&", '<a x=">"', "<i></b>"]


@pytest.mark.parametrize("part", HOSTILE)
def test_malformed_pages_take_time_in_proportion(part):
    begin = time.process_time()
    html.container_scores(*html.parse_or_all(part * (1_000_000 // len(part))))
    assert time.process_time() - begin < 10


def test_deep_nesting_is_read_as_browsers_do():
    blocks, nodes = html.parse("<div>" * 20_000 + "<p>deep</p>" + "<aside>" * 600 + "gone")
    assert [b[0] for b in blocks] == ["deep"] and max(len(n[1]) for n in nodes) <= html.PATH_CHARS


def test_marks_of_leaves_and_odd_tags():
    texts = lambda body: [b[0] for b in html.parse(f"<article>{body}</article>")[0]]
    assert texts('<p class="share-price">kept</p><ul><li class="related-x">kept too</ul><p class="social-share">gone</p><p class="cookie-notice">gone</p>') == ["kept", "kept too"]
    assert texts("<p title='a > b'>one</p><p title=\"it's\">two</p><p>3 < 4 and <b>bold") == ["one", "two", "3 < 4 and bold"]
    assert texts('<a href="never closed>text</a><p>rest</p>') == ["text", "rest"]
    assert texts("<p>&#00000000065;&#99999999999;</p>")[0][-1] == "\ufffd"


def test_pages_without_a_strong_path_take_the_hosts_choice(spark):
    """Sixty layouts of which none is strong: the page's paths compete by the votes of the whole host."""
    text = " ".join(["word"] * 40)
    rows = [(i, "http://h.example/", f'<div class="l{chr(97 + i % 26)}{chr(97 + i // 26)}"><p>{text} {i}</p></div>') for i in range(60)]
    rows += [(100, "http://h.example/", f'<div class="laa"><p>{text}</p></div><div class="zz"><p>{text} and some more</p></div>')] + [rows[0]]
    got = [(r.page_id, r.text) for r in html.main_text(spark.createDataFrame(rows, "page_id long, url string, html string")).collect()]
    assert sorted(got) == sorted([(i, f"{text} {i}") for i in [0, *range(60)]] + [(100, text)])


def test_draws_beyond_the_generators_range_follow_the_law():
    draw = np.random.default_rng(3)
    good, bad, sample = 600, 1400, 50
    got = np.array([sharding.inverse_draw(u, good, bad, sample) for u in draw.random(20_000)])
    want = draw.hypergeometric(good, bad, sample, 20_000)
    assert abs(got.mean() - want.mean()) < 0.1 and abs(got.std() - want.std()) < 0.1 and got.min() >= 0 and got.max() <= sample
    edges = np.cumsum([math.comb(6, k) * math.comb(4, 5 - k) / math.comb(10, 5) for k in range(1, 6)])
    for u in draw.random(200):
        assert sharding.inverse_draw(u, 6, 4, 5) == 1 + int(np.searchsorted(edges, u, side="right"))
    sizes = [10**9, 3 * 10**9, 17, 0]
    matrix = sharding.communication_matrix(sizes, 16, 1)
    assert matrix.sum(axis=1).tolist() == sizes and np.ptp(matrix.sum(axis=0)) <= 1 and (matrix >= 0).all()


def test_shards_match_a_plain_simulation(spark):
    """The registered query against the same draws, ranks and slots in loops."""
    folder = "/root/testdata/sf0.001"
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    body, key = F.coalesce("text", F.lit("")), ["doc_id", "size", "text_crc32"]
    rows = docs.select("doc_id", (F.octet_length(body) + 1).cast("long").alias("size"), F.crc32(F.encode(body, "UTF-8")).alias("text_crc32"))
    rows = rows.select("*", *[F.xxhash64(*key, F.lit(s)).alias(f"h{s}") for s in range(3)]).collect()
    parts = [[] for _ in range(sharding.MIN_PARTS)]
    for r in rows:
        parts[r.h0 % len(parts)].append(r)
    matrix, shards = sharding.communication_matrix([len(p) for p in parts], sharding.SHARDS, 0), [[] for _ in range(sharding.SHARDS)]
    for p, counts in zip(parts, matrix):
        left = iter(sorted(p, key=lambda r: (r.h1, r.doc_id, r.size, r.text_crc32)))
        for shard, n in zip(shards, counts):
            shard += [next(left) for _ in range(n)]
    want = set()
    for j, shard in enumerate(shards):
        shard.sort(key=lambda r: (r.h2 % 2**64 >> 33, r.h2, r.doc_id))
        want |= {(r.doc_id, r.size, r.text_crc32, j, slot) for slot, r in enumerate(shard)}
    got = {(r.doc_id, r.size, r.text_crc32, r.shard, r.slot) for r in queries.op3_sharding(spark, folder).collect()}
    assert len(got) == len(rows) and {x[:4] for x in got} == {x[:4] for x in want}
    assert all(sorted(x[4] for x in got if x[3] == j) == list(range(len(shards[j]))) for j in range(len(shards)))


def test_recursions_are_the_same_whether_texts_are_cut_or_not(monkeypatch):
    draw = np.random.default_rng(5)
    model = hmm.Model(draw.dirichlet(np.ones(hmm.STATES)), draw.dirichlet(np.ones(hmm.STATES), hmm.STATES), draw.dirichlet(np.ones(hmm.CLASSES), hmm.STATES).T + 1e-6)
    lengths = np.array([1, 900, 37, 64, 65, 300])
    flat = draw.integers(0, hmm.CLASSES, lengths.sum())
    whole = hmm.expected_counts(model, flat, lengths), hmm.log10_likelihoods(model, flat, lengths)
    moves = whole[0][hmm.CLASSES : hmm.CLASSES + hmm.STATES]
    assert moves.sum() == pytest.approx(lengths.sum() - len(lengths), rel=1e-4) and whole[0][-1].sum() == pytest.approx(len(lengths), rel=1e-4)
    for cut_at in ((1, 7), (64, 32), (200, 150)):
        monkeypatch.setattr(hmm, "WHOLE", cut_at[0])
        monkeypatch.setattr(hmm, "SEGMENT", cut_at[1])
        assert hmm.expected_counts(model, flat, lengths) == pytest.approx(whole[0], abs=1e-3) and hmm.log10_likelihoods(model, flat, lengths) == pytest.approx(whole[1])


def test_groups_link_what_all_pairs_link(monkeypatch):
    """Templates, near copies and chains in one group, against every pair; then across two blocks."""
    draw = np.random.default_rng(6)
    template = draw.integers(0, 2**63, 60, dtype=np.uint64)
    sets = []
    for _ in range(150):
        base = np.concatenate((template[: draw.integers(30, 60)], draw.integers(0, 2**63, draw.integers(1, 15), dtype=np.uint64)))
        sets += [np.unique(np.concatenate((base[draw.random(len(base)) < 0.93], draw.integers(0, 2**63, 3, dtype=np.uint64)))) for _ in range(draw.integers(1, 5))]
    bounds = np.concatenate(([0], np.cumsum([len(x) for x in sets])))
    signature = minhash.signatures(np.concatenate(sets), bounds)
    sketch = ((signature * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(56)).astype(np.uint8)
    same = np.array([[len(np.intersect1d(a, b, assume_unique=True)) for b in sets] for a in sets])
    size = np.array([len(x) for x in sets])
    linked = 100 * same >= 75 * (size[:, None] + size - same)
    ids = draw.permutation(len(sets)).astype(np.int64)
    for side in (None, draw.integers(0, 2, len(sets))):
        allowed = linked if side is None else linked & (side[:, None] != side)
        low = ids.copy()
        for _ in range(len(sets)):
            fresh = np.minimum(low, np.where(allowed, low, len(sets)).min(axis=1))
            if (fresh == low).all():
                break
            low = fresh
        assert minhash._links(ids, sets, sketch, side).tolist() == low.tolist()


def test_template_pages_cost_in_proportion():
    """Pages of one template, similar at about a half: four times as many may not cost sixteen times as much."""
    draw = np.random.default_rng(7)
    template, seconds = draw.integers(0, 2**63, 30, dtype=np.uint64), []
    for n in (4000, 16000):
        sets = [np.sort(np.concatenate((template, draw.integers(0, 2**63, 14, dtype=np.uint64)))) for _ in range(n)]
        sketch = draw.integers(0, 3, (n, 2 * minhash.PERMUTATIONS), dtype=np.uint8)
        begin = time.process_time()
        assert (minhash._links(np.arange(n), sets, sketch, None) == np.arange(n)).all()
        seconds.append(time.process_time() - begin)
    assert seconds[1] < 8 * seconds[0] + 1


def test_stages_with_clashing_columns(spark, tmp_path):
    docs = spark.createDataFrame(corpus(30, seed=4), SCHEMA)
    plain = {}
    items = spark.createDataFrame([(1, "kilo lima mike november oscar papa. quebec romeo")], "item_id long, text string")
    items.write.parquet(f"{tmp_path}/benchmark.parquet")
    names = "_key _id id key row row_key kept_text kept hit rep component n_words starts text2 a.b ids lang2 item_id score".split()
    wide = docs.select("*", *[F.lit(k).alias(n) for k, n in enumerate(names)])
    for stage in (stages.keep_good, stages.drop_near_duplicates, stages.cut_repeated_passages, stages.drop_contaminated):
        plain = stage(spark, docs, str(tmp_path))
        got = stage(spark, wide, str(tmp_path))
        assert got.columns == wide.columns and plain.columns == docs.columns
        assert sorted(map(repr, got.select(*docs.columns).collect())) == sorted(map(repr, plain.collect()))
        assert got.where("id <> 2").count() == 0
    packed = stages.pack_sequences(spark, wide, str(tmp_path)).collect()
    for r in packed:
        assert len(r.ids) == 4 * r.length and zlib.crc32(r.ids) == r.ids_crc32


def test_language_matches_votes_in_loops(spark):
    """The registered query's rows against one-versus-one votes counted row by row with the same fitted machines."""
    folder = "/root/testdata/sf0.001"
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    held = lambda i: zlib.crc32(str(i).encode()) % 5 == 0
    model = language.fit(docs.where(F.pmod(F.crc32(F.encode(F.col("doc_id").cast("string"), "UTF-8")), F.lit(5)) != 0).select("doc_id", "text", "lang"))

    def vote(votes, x):
        wins, sums = dict.fromkeys(votes.names, 0), dict.fromkeys(votes.names, 0.0)
        for (i, j), w in zip(votes.pairs, votes.weights):
            m = float(x @ w[:-1].astype(np.float32) + w[-1])
            wins[votes.names[i if m >= 0 else j]] += 1
            sums[votes.names[i]] += max(-2, min(2, m))
            sums[votes.names[j]] -= max(-2, min(2, m))
        return max(votes.names, key=lambda n: wins[n] + sums[n] * 1e-3 / len(votes.names))

    texts = {r.doc_id: r.text for r in docs.select("doc_id", "text").collect()}
    got = queries.op5_language(spark, folder).collect()
    assert len(got) == len(texts)
    for r in got:
        text = texts[r.doc_id]
        if text is None or not any(c.isalpha() for c in text):
            assert (r.lang_pred, r.score) == ("und", 0)
        else:
            x = language.features(pa.array([text]))[0]
            assert r.lang_pred == vote(model.members[vote(model.families, x)], x) and 0 <= r.score <= 1
        assert r.held_out == held(r.doc_id)
