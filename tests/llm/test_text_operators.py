"""Near-duplicates, repeated passages, quality rules, sharding, packing, LM and decontamination against brute force and edge cases."""

import hashlib
import math
import random
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from quarryframe.llm import decontaminate, hmm, language, minhash, packing, quality, sharding, substring
from quarryframe.llm.components import connected_components
from quarryframe.llm.queries import tokenizer_path
from quarryframe.llm.textkit import Words, chunks, window_hashes

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"
WORD = re.compile(r"[^\x20\x09-\x0D]+")
LOWER = {i: i + 32 for i in range(65, 91)}


def corpus(n=60, seed=1):
    """Rows with copies, near copies, shared passages, null, empty, blank, short and long texts, ties and repeated rows."""
    r = random.Random(seed)
    word = lambda: "".join(r.choice("abcdeé") for _ in range(r.randint(1, 5)))
    passage = " ".join(word() for _ in range(70))
    rows = []
    for i in range(n):
        words = [word() for _ in range(r.randint(60, 140))]
        kind = i % 6
        if kind == 1:
            words = rows[i - 1][1].split()
            for _ in range(r.randint(0, 4)):
                words[r.randrange(len(words))] = word().upper()
        elif kind == 2:
            words[20:20] = passage.split()
        elif kind == 3:
            words = rows[i - 3][1].split()
        rows.append((i * 3, ("\n" if kind == 4 else " ").join(words), r.choice(["en", "fr", None]), r.choice(["a", "b", None]), 1))
    rows += [(1000, None, None, None, None), (1001, "", "en", "a", 0), (1002, " \t\n\x0b ", "en", "a", 5), (1003, "one two", "en", "a", 7), (1004, "ONE two", "en", "a", 7)]
    rows += [(1005, "w" * 50_000, "en", "a", 1), (1006, "tic tac " * 9_000, "en", "a", 1), (None, rows[0][1], "en", "a", 1), (1007, "x\x85y z ­  q", "en", "a", 1)]
    rows.append(rows[5])  # a repeated row
    return rows


@pytest.fixture(scope="module")
def docs(spark):
    return spark.createDataFrame(corpus(), SCHEMA).withColumns({"kept": F.lit("clash"), "bucket": F.lit(1), "n_words": F.lit("clash")}).repartition(3).cache()


@pytest.fixture(scope="module")
def empty(spark):
    return spark.createDataFrame([], SCHEMA)


def shingles(text):
    w = WORD.findall((text or "").translate(LOWER))
    return frozenset(tuple(w[i : i + 5]) for i in range(len(w) - 4)) if len(w) >= 5 else frozenset([tuple(w)] if w else [])


def test_words_follow_the_byte_rule():
    texts = ["a  b\tc", None, "", " x", "y ", "é\x85z w v", "\x0b\x0c\r\n", "end"]
    words = Words(pa.array(texts))
    assert words.counts.tolist() == [len(WORD.findall(t or "")) for t in texts]
    raw = words.data.tobytes()
    assert [raw[a:b].decode() for a, b in zip(words.starts, words.ends)] == [w for t in texts for w in WORD.findall(t or "")]


def test_word_hash_depends_on_the_word_only():
    a = Words(pa.array(["foo bar", "Bar FOO foo"]))
    h, low = a.hashes(False), a.hashes(True)
    assert h[0] == h[4] and h[1] != h[2] and low[1] == low[2] and low[0] == low[3] == low[4]


def test_window_hashes_are_equal_for_equal_runs():
    h = Words(pa.array(["a b c d e x a b c d e"])).hashes(False)
    w = window_hashes(h, 5)
    assert w[0] == w[6] and len(set(w.tolist())) == len(w) - 1


def test_chunks_cut_by_bytes_and_keep_rows():
    batch = pa.RecordBatch.from_arrays([pa.array(["a" * 100, "b" * 10, None, "c" * 500, ""])], names=["text"])
    parts = list(chunks(iter([batch]), limit=120))
    assert sum(p.num_rows for p in parts) == 5 and [t for p in parts for t in p.column("text").to_pylist()] == batch.column("text").to_pylist()


def test_connected_components(spark):
    r = random.Random(3)
    edges = [(r.randrange(400), r.randrange(400)) for _ in range(260)] + [(500 + i, 501 + i) for i in range(60)] + [(7, 7), (None, 3)]
    parent = {}

    def find(x):
        parent.setdefault(x, x)
        while parent[x] != x:
            x = parent[x]
        return x

    for a, b in edges:
        if a is not None and a != b:
            a, b = sorted((find(a), find(b)))
            parent[b] = a
    got = {x.id: x.component for x in connected_components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert got == {x: find(x) for x in parent}
    assert connected_components(spark.createDataFrame([], "a long, b long")).count() == 0


def test_near_duplicates_match_brute_force(docs):
    rows = [(r.doc_id, r.text) for r in docs.collect()]
    sets = {i: shingles(t) for i, t in rows if i is not None}
    label = {i: i for i in sets}
    ids = sorted(sets)
    changed = True
    while changed:
        changed = False
        for i, a in enumerate(ids):
            for b in ids[i + 1 :]:
                same = len(sets[a] & sets[b])
                if same and 100 * same >= 75 * len(sets[a] | sets[b]) and label[a] != label[b]:
                    label[a] = label[b] = min(label[a], label[b])
                    changed = True
    got = minhash.near_duplicates(docs).collect()
    assert len(got) == len(rows)
    for r in got:
        if r.doc_id is None:
            assert r.component_id is None and r.kept
        else:
            assert (r.n_shingles, r.component_id, r.kept) == (len(sets[r.doc_id]), label[r.doc_id], label[r.doc_id] == r.doc_id)


def test_large_groups_are_linked_in_blocks(docs, monkeypatch):
    whole = sorted(map(tuple, minhash.near_duplicates(docs).where("doc_id is not null").collect()))
    monkeypatch.setattr(minhash, "GROUP_SHINGLES", 60)
    assert sorted(map(tuple, minhash.near_duplicates(docs).where("doc_id is not null").collect())) == whole


def test_signature_estimates_similarity():
    r = np.random.default_rng(0)
    a, b = r.integers(0, 2**63, 600, dtype=np.uint64), r.integers(0, 2**63, 600, dtype=np.uint64)
    b[:450] = a[:450]
    s = minhash.signatures(np.concatenate((a, b)), np.array([0, 600, 1200]))
    assert abs((s[0] == s[1]).mean() - 450 / 750) < 0.12


def brute_passages(rows):
    starts, out = {}, []
    windows = {}
    for i, t in rows:
        w = WORD.findall(t or "")
        windows[i, t] = [tuple(w[k : k + 50]) for k in range(len(w) - 49)]
        if i is not None:
            for x in windows[i, t]:
                starts[x] = min(starts.get(x, i), i)
    for i, t in rows:
        w = WORD.findall(t or "")
        gone = {k + j for k, x in enumerate(windows[i, t]) if i is not None and starts[x] < i for j in range(50)}
        out.append((i, len(w), len(gone), hashlib.sha256(" ".join(x for k, x in enumerate(w) if k not in gone).encode()).hexdigest()))
    return sorted(out, key=repr)


def test_repeated_passages_match_brute_force(docs):
    rows = [(r.doc_id, r.text) for r in docs.collect()]
    got = substring.repeated_passages(docs, with_text=True).collect()
    assert sorted([(r.doc_id, r.n_words, r.n_removed, r.kept_sha256) for r in got], key=repr) == brute_passages(rows)
    assert any(r.n_removed for r in got)
    for r in got:
        if r.kept_text is not None:
            assert hashlib.sha256(" ".join(WORD.findall(r.kept_text)).encode()).hexdigest() == r.kept_sha256


def test_quality_counts_match_brute_force(docs):
    texts = defaultdict(list)
    for r in docs.collect():
        texts[r.doc_id].append(r.text or "")
    got = quality.quality_verdicts(docs).collect()
    assert len(got) == sum(map(len, texts.values()))
    for r in got:
        t = texts[r.doc_id][0]
        w = WORD.findall(t)
        tri = Counter(zip(w, w[1:], w[2:]))
        cover = {i + k for i in range(len(w) - 2) if tri[w[i], w[i + 1], w[i + 2]] > 1 for k in range(3)}
        lines = [x for x in t.split("\n") if WORD.search(x)]
        expected = (len(w), sum(map(len, w)), sum(c in "#*$%&|<>" for c in t), len(lines) - len(set(lines)), len(cover))
        assert (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words) == expected
        assert r.base_failed == (len(w) < 50 or 100 * len(cover) > 50 * len(w)) and not (r.base_failed and r.kept)


def test_quality_fences_adapt_to_their_group(spark):
    r = random.Random(5)
    text = lambda symbols: " ".join([f"w{r.randrange(10**6)}" for _ in range(100)] + ["##"] * symbols)
    rows = [(i, text(r.randint(0, 2)), "en", "clean", 1) for i in range(40)] + [(100 + i, text(r.randint(20, 26)), "en", "code", 1) for i in range(40)] + [(200, text(25), "en", "clean", 1), (201, text(25), "en", "code", 1)]
    got = {x.doc_id: x.kept for x in quality.quality_verdicts(spark.createDataFrame(rows, SCHEMA)).collect()}
    assert not got[200] and got[201] and sum(got.values()) == len(rows) - 1


def test_communication_matrix_has_exact_margins():
    for sizes in ([5, 0, 17, 3], [1], [0, 0], [1000, 1, 999]):
        m = sharding.communication_matrix(sizes, 4, 9)
        assert m.sum(axis=1).tolist() == sizes and m.sum(axis=0).max() - m.sum(axis=0).min() <= 1 and (m >= 0).all()
    total = sum(sharding.communication_matrix([10, 30], 2, s)[0, 0] for s in range(400))
    assert abs(total / 400 - 5) < 0.3


def test_shards_are_exact_and_repeatable(docs):
    a, b = sharding.uniform_shards(docs), sharding.uniform_shards(docs.repartition(7))
    rows = a.collect()
    counts, slots = Counter(r.shard for r in rows), defaultdict(list)
    for r in rows:
        slots[r.shard].append(r.slot)
    assert len(rows) == docs.count() and set(counts) <= set(range(16)) and max(counts.values()) - min(counts.values()) <= 1
    assert all(sorted(s) == list(range(len(s))) for s in slots.values())
    assert sorted(map(repr, rows)) == sorted(map(repr, b.collect()))
    by_id = {r.doc_id: r.text for r in docs.collect()}
    assert all(r.size == len((by_id[r.doc_id] or "").encode()) + 1 and r.text_crc32 == zlib.crc32((by_id[r.doc_id] or "").encode()) for r in rows)


def test_encoder_gives_the_ids_of_the_tokenizers_library():
    from tokenizers import Tokenizer

    reference, own = Tokenizer.from_file(tokenizer_path()), packing.encoder(tokenizer_path())
    r = random.Random(2)
    texts = ["", "a  b   c\n\n\n  d", "don't I'LL <|endoftext|>x ²³½ 日本語🙂👩‍👩‍👧", "\x85 \x1c\x1d x​᠎", "x" * 3000, " " * 500, "﻿\u0000 y", "Ⅷ ٣ ́é ß"]
    texts += ["".join(chr(r.choice([r.randrange(32, 127), r.randrange(160, 0x2000), r.randrange(0x1F300, 0x1F600)])) for _ in range(200)) for _ in range(50)]
    for t in texts:
        assert reference.encode(t, add_special_tokens=False).ids == own(t).tolist()


def test_minimum_bin_slack_places_every_item():
    r = random.Random(4)
    for _ in range(20):
        counts = {r.randint(1, 100): r.randint(1, 50) for _ in range(r.randint(1, 40))}
        plan, used = packing.minimum_bin_slack(counts, 100), Counter()
        for pattern, times in plan:
            assert sum(k * n for k, n in pattern.items()) <= 100 and times > 0
            used.update({k: n * times for k, n in pattern.items()})
        assert used == Counter(counts)
    assert packing.minimum_bin_slack({6: 1, 5: 2, 4: 1}, 10) == [({6: 1, 4: 1}, 1), ({5: 2}, 1)]


def test_packing_places_every_id_once(docs):
    rows = packing.pack(docs, tokenizer_path(), with_ids=True).collect()
    encode, texts = packing.encoder(tokenizer_path()), Counter()
    for r in docs.collect():
        texts[r.doc_id, tuple(encode(r.text or "").tolist()) + (0,)] += 1
    sequences = defaultdict(list)
    by_doc = defaultdict(list)
    for r in rows:
        ids = np.frombuffer(r.ids, "<u4")
        assert len(ids) == r.length and zlib.crc32(bytes(r.ids)) == r.ids_crc32
        sequences[r.sequence_id].append((r.offset, r.length))
        by_doc[r.doc_id].append((r.start, tuple(ids.tolist()), r.doc_tokens))
    assert sorted(sequences) == list(range(len(sequences)))
    for pieces in sequences.values():
        at = 0
        for offset, length in sorted(pieces):
            assert offset == at
            at += length
        assert at <= 1024
    got = Counter()
    for doc, pieces in by_doc.items():
        times = len([1 for s, _, _ in pieces if s == 0])
        for _ in range(1):
            whole = sum((ids for _, ids in sorted({(s, ids) for s, ids, _ in pieces})), ())
            got[doc, whole] += times
            assert all(n == len(whole) for _, _, n in pieces)
    assert got == texts


def test_lm_base_scores_match_brute_force(docs):
    texts = [(r.doc_id, r.text or "") for r in docs.collect()]
    tokens = [(i, [*WORD.findall(t.translate(LOWER)), None]) for i, t in texts]
    held = lambda i: i is None or zlib.crc32(str(i).encode()) % 7 == 2
    count = Counter()
    for i, w in tokens:
        if not held(i):
            count.update(w)
    n, v = sum(count.values()), len(count)
    expected = {(i, len(w)): (held(i), sum(count[x] > 0 for x in w), n, sum(math.log10((count[x] + 1) / (n + v + 1)) for x in w)) for i, w in tokens}
    rows = hmm.lm_scores(docs).collect()
    assert len(rows) == len(tokens)
    for r in rows:
        e = expected[r.doc_id, r.n_tokens]
        assert (r.held_out, r.n_known, r.train_tokens) == e[:3] and r.base_score == pytest.approx(e[3], abs=1e-6)
        assert r.score < 0 and math.isfinite(r.score)


def test_forward_recursion_is_exact():
    draw = np.random.default_rng(1)
    norm = lambda x, axis: x / x.sum(axis=axis, keepdims=True)
    model = hmm.Model(norm(draw.random(hmm.STATES), 0), norm(draw.random((hmm.STATES, hmm.STATES)), 1), norm(draw.random((hmm.CLASSES, hmm.STATES)), 0))
    lengths = np.array([3, 1, 5, 2])
    flat = draw.integers(0, hmm.CLASSES, lengths.sum())
    got, at = hmm.log10_likelihoods(model, flat, lengths), 0
    for k, n in enumerate(lengths):
        state = model.start * model.emit[flat[at]]
        for t in range(1, n):
            state = (state @ model.move) * model.emit[flat[at + t]]
        assert got[k] == pytest.approx(math.log10(state.sum()))
        at += n


def test_baum_welch_raises_the_likelihood():
    draw = np.random.default_rng(2)
    lengths = draw.integers(2, 700, 30)
    flat = np.concatenate([(draw.integers(0, 40, n) + 40 * (i % 2)) for i, n in enumerate(lengths)])
    share = np.full(hmm.CLASSES, 1 / hmm.CLASSES)
    model, scores = hmm.Model.first(share), []
    for _ in range(6):
        counts = hmm.expected_counts(model, flat, lengths)
        assert counts[: hmm.CLASSES].sum() == pytest.approx(len(flat)) and counts[-1].sum() == pytest.approx(len(lengths))
        scores.append(hmm.log10_likelihoods(model, flat, lengths).sum())
        model = model.update(counts, share)
    assert all(b > a for a, b in zip(scores, scores[1:]))


def brute_leaks(docs, items):
    norm = lambda s: " " + " ".join(re.findall(r"[0-9a-z\u0080-\U0010ffff]+", (s or "").lower())) + " "
    return {(i, j) for i, t in docs for j, s in items if norm(s).strip() and norm(s) in norm(t)}


def test_decontamination_finds_planted_items(spark, docs):
    r = random.Random(8)
    word = lambda: "".join(r.choice("klmnopqrst") for _ in range(r.randint(2, 6)))
    items = [(j, f"{' '.join(word() for _ in range(r.randint(8, 40)))}.\n{' '.join(word() for _ in range(r.randint(1, 12)))}") for j in range(60)] + [(None, None), (77, ""), (78, "!!")]
    rows = [(r0.doc_id, r0.text) for r0 in docs.collect()]
    rows += [(5000 + j, " ".join(word() for _ in range(r.randint(0, 300))) + " " + items[j][1].upper().replace("\n", "  ") + ", " + " ".join(word() for _ in range(90))) for j in range(30)]
    table = spark.createDataFrame(rows, "doc_id long, text string")
    found = decontaminate.contaminated(table, spark.createDataFrame(items, "item_id long, text string"))
    assert {(x.doc_id, x.item_id) for x in found.collect()} == brute_leaks(rows, [x for x in items if x[1]])


def test_decontamination_in_several_passes(spark, monkeypatch):
    items = [(j, f"alpha{j} beta{j} gamma{j} delta{j} epsilon{j}. zeta{j} eta{j}") for j in range(9)]
    rows = [(j, f"so it goes {items[j][1]} and on") for j in range(9)]
    tables = spark.createDataFrame(rows, "doc_id long, text string"), spark.createDataFrame(items, "item_id long, text string")
    monkeypatch.setattr(decontaminate, "INDEX_WORDS", 20)
    assert {(x.doc_id, x.item_id) for x in decontaminate.contaminated(*tables).collect()} == {(j, j) for j in range(9)}


def test_block_bounds_lose_nothing(spark, docs):
    """Every passage scored against every item, against what the bounded search retrieves."""
    items = [(j, " ".join(WORD.findall(t)[5:30])) for j, t in enumerate(r.text for r in docs.where("length(text) > 400").limit(20).collect())]
    index_words = Words(pa.array([t.lower() for _, t in items]), letters_only=True)
    h, df = index_words.hashes(False), Counter()
    for a, b in zip(index_words.bounds[:-1], index_words.bounds[1:]):
        df.update(set(h[a:b].view(np.int64).tolist()))
    index = decontaminate.Index([i for i, _ in items], [t for _, t in items], df, len(items), float(np.diff(index_words.bounds).mean()), 64)
    texts = [r.text.lower() for r in docs.where("text is not null").collect()]
    words = Words(pa.array(texts), letters_only=True)
    own = words.hashes(False)
    got = {(r, i) for r, i, *_ in index.hits(words, own)}
    impact = defaultdict(dict)
    for k, term in enumerate(index.terms.tolist()):
        for e in range(index.postings[k], index.postings[k + 1]):
            impact[term][int(index.item[e])] = index.impact[e]
    for r in range(len(texts)):
        text = own[words.bounds[r] : words.bounds[r + 1]]
        for start in range(0, len(text), index.stride):
            score = Counter()
            for term in set(text[start : start + 2 * index.stride].tolist()):
                score.update(impact.get(term, {}))
            for i, s in score.items():
                q, a = index.parts[i]
                inside = decontaminate._runs(text[start : start + 2 * index.stride])
                if s >= decontaminate.LEAST_SCORE + 1e-9 and all(np.isin(decontaminate._runs(p), inside).mean() >= decontaminate.LEAST_OVERLAP for p in (q, a) if len(p) >= 3):
                    assert (r, i) in got


def test_language_on_held_out_rows(spark):
    r = random.Random(3)
    vocabulary = {"en": "the of and to that with have this from they", "de": "der die und nicht sich auch werden schon zwischen über", "fr": "le la et les dans que pour avec être où", "es": "el los y que para con una más señor año"}
    rows = []
    for i in range(400):
        lang = r.choice(list(vocabulary))
        rows.append((i, " ".join(r.choice(vocabulary[lang].split()) for _ in range(r.randint(6, 40))), lang if r.random() < 0.9 else None, "s", lang))
    rows += [(900, None, "en", "s", None), (901, "12 + 7 = 19!", "fr", "s", None), (902, "", None, "s", None), (None, "the of and that with", None, "s", "en")]
    got = language.language_id(spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, truth string"))
    by_id = {x.doc_id: x for x in got.collect()}
    assert len(by_id) == len(rows)
    held = [(by_id[i].lang_pred == t) for i, _, _, _, t in rows if t and i is not None and by_id[i].held_out]
    assert len(held) > 50 and sum(held) / len(held) > 0.97
    assert all(by_id[i].lang_pred == "und" and by_id[i].score == 0 for i in (900, 901, 902)) and by_id[None].lang_pred == "en" and by_id[None].held_out
    assert all(0 <= x.score <= 1 and (x.doc_id is None or x.held_out == (zlib.crc32(str(x.doc_id).encode()) % 5 == 0)) for x in by_id.values())


def test_language_without_labels(spark):
    rows = spark.createDataFrame([(1, "abc", None)], "doc_id long, text string, lang string")
    assert [x.lang_pred for x in language.language_id(rows).collect()] == ["und"]


@pytest.mark.parametrize("operator", [minhash.near_duplicates, substring.repeated_passages, quality.quality_verdicts, sharding.uniform_shards, language.language_id, hmm.lm_scores, lambda d: packing.pack(d, tokenizer_path())])
def test_empty_tables(operator, empty):
    assert operator(empty).collect() == []


def test_empty_tables_of_decontamination(spark, empty):
    items = spark.createDataFrame([(1, "a b c d")], "item_id long, text string")
    assert decontaminate.contaminated(empty, items).collect() == [] and decontaminate.contaminated(empty, items.limit(0)).collect() == []


@pytest.mark.parametrize("operator", [minhash.near_duplicates, substring.repeated_passages, quality.quality_verdicts, sharding.uniform_shards, hmm.lm_scores, lambda d: packing.pack(d, tokenizer_path())])
def test_all_null_columns(operator, spark):
    rows = spark.createDataFrame([(None, None, None, None, None), (None, None, None, None, None), (3, None, None, None, None)], SCHEMA)
    assert len(operator(rows).collect()) == 3
