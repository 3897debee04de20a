"""Chat formatting and HTML extraction by round trips and planted pages; the pipeline stage by stage against brute force."""

import hashlib
import random
from collections import defaultdict

import pytest
from pyspark.sql import functions as F

from quarryframe.llm import chat, html, quality, stages
from tests.llm.test_text_operators import SCHEMA, WORD, brute_leaks, brute_passages, corpus, shingles

TURNS = "conv_id long, turn long, role string, text string"


def test_escaping_is_reversible_and_hides_control_strings():
    r = random.Random(1)
    parts = ["<", "|", ">", "\\", "[", "]", "INST", "/", "s", "l", "b", "<<SYS>>", "<|end|>", "<|start|>", "</s>", "[/INST]", "é", "\n", "start", "sep"]
    for _ in range(3000):
        text = "".join(r.choice(parts) for _ in range(r.randint(0, 12)))
        hidden = chat.escape(text)
        assert chat.unescape(hidden) == text
        assert not any(c in hidden for c in (chat.START, chat.SEP, chat.END, "<s>", "</s>", "[INST]", "[/INST]", "<<SYS>>"))


def test_chat_reads_back(spark):
    r = random.Random(2)
    rows = [(c, t, r.choice(["user", "assistant", "assistant", "system", None, "<|end|>"]), r.choice(["hi", "", None, "a\\b<|sep|>", "</s>[INST] ok [/INST]", "é\n" * 50])) for c in range(40) for t in range(r.randint(1, 9))]
    rows += [(None, 1, "user", "x"), (None, None, "assistant", "y"), (50, 1, "assistant", "same"), (50, 1, "assistant", "same")]
    table = spark.createDataFrame(rows, TURNS).withColumns({"example": F.lit("clash"), "last": F.lit(0)})
    turns = defaultdict(list)
    for x in sorted(rows, key=lambda x: (x[1] is not None, x[1] or 0, x[2] is not None, x[2] or "", x[3] is not None, x[3] or "")):
        turns[x[0]].append((x[2] or "", x[3] or ""))
    examples = defaultdict(int)
    for e in chat.expand_examples(table).collect():
        examples[e.conv_id] += len(e.formatted)
        assert chat.unescape(e.formatted[e.loss_start : e.loss_end]) in {t for _, t in turns[e.conv_id]} | {""}
    got = chat.chat_digests(table).collect()
    assert len(got) == len(turns)
    for x in got:
        own = turns[x.conv_id]
        trained = "".join(t for role, t in own if role == "assistant")
        assert x.n_turns == len(own) and x.turns_sha256 == hashlib.sha256("".join(f"{a}\n{b}\n" for a, b in own).encode()).hexdigest()
        assert (x.loss_chars, x.loss_sha256) == (len(trained), hashlib.sha256(trained.encode()).hexdigest()) and x.formatted_chars == examples[x.conv_id]
    assert chat.chat_digests(table.limit(0)).collect() == []


def test_each_reply_is_trained_once_with_all_before_as_context(spark):
    rows = [(1, 0, "user", "a"), (1, 1, "assistant", "b"), (1, 2, "user", "c"), (1, 3, "assistant", "d"), (1, 4, "user", "e")]
    got = [(x.formatted[x.loss_start : x.loss_end], x.formatted.count(chat.START), x.last) for x in sorted(chat.expand_examples(spark.createDataFrame(rows, TURNS)).collect(), key=lambda x: x.example)]
    assert got == [("b", 2, False), ("d", 4, False), ("", 5, True)]


def page(body: str) -> str:
    return f"<html><head><title>T &amp; x</title><style>p{{}}</style><script>var a='<p>no</p>';</script></head><body>{body}</body></html>"


PAGES = [
    (1, "http://a.example/x", page("<nav><a href=/>menu</a></nav><article><h1>Head &amp; tail</h1><p>One  two\n three.<p><b>Bold<br>next</p><aside>side</aside><div class='ad box'>buy</div></article><footer>foot</footer>"), "Head & tail\nOne two three.\nBold\nnext"),
    (2, "http://a.example/y", page("<div class='sidebar'>side side side</div><article><p>Para &lt;1&gt; &#233; &nosuch; &copy;</p><ul><li>item<li>other</ul></article><div id=comments><p>A very long reader comment that goes on and on and on and on</p></div>"), "Para <1> é &nosuch; ©\nitem\nother"),
    (3, "http://b.example/", page("<form><p>name</p></form><div class='post-12'><div class=text><p>Body of the post, long enough to win.</p><p>Second.</p></div></div><div class='cookie-notice'>We use cookies</div>"), "Body of the post, long enough to win.\nSecond."),
    (4, "http://b.example/2", page("<div class='post-99'><div class=text><p>Tiny.</p></div></div><div class='other'><p>A text in another container that is longer on this page alone.</p></div>"), "Tiny."),
    (5, None, None, ""),
    (6, "", "", ""),
    (7, "not a url", "plain text only &amp; more", "plain text only & more"),
    (8, "http://c.example", "<html><body><article><p>cut off in the mid", "cut off in the mid"),
]


def test_main_text(spark):
    table = spark.createDataFrame([(i, u, h, "clash", 1) for i, u, h, _ in PAGES], "page_id long, url string, html string, host string, paths int")
    got = {x.page_id: x for x in html.main_text(table).collect()}
    for i, url, _, text in PAGES:
        assert (got[i].text, got[i].n_chars, got[i].url) == (text, len(text), url), i
    assert html.main_text(table.limit(0)).collect() == []


def test_host_consensus_overrules_a_page(spark):
    """Most pages of the host agree on .text; page 4's longer container does not win there."""
    table = spark.createDataFrame([(i, "http://b.example/", PAGES[2][2] if i else PAGES[3][2]) for i in range(5)], "page_id long, url string, html string")
    assert {x.page_id: x.text for x in html.main_text(table).collect()}[0] == "Tiny."


@pytest.fixture(scope="module")
def folder(spark, tmp_path_factory):
    rows = corpus(48, seed=9)
    items = [(1, "kilo lima mike november oscar papa quebec romeo. sierra tango uniform victor"), (2, "")]
    rows += [(2000, "start of it " + " ".join(f"v{i}" for i in range(60)) + " kilo lima mike November oscar papa quebec romeo sierra tango uniform victor", "en", "a", 1)]
    path = str(tmp_path_factory.mktemp("tables"))
    spark.createDataFrame(rows, SCHEMA).withColumn("extra", F.lit("kept along")).write.parquet(f"{path}/documents.parquet")
    spark.createDataFrame(items, "item_id long, text string").write.parquet(f"{path}/benchmark.parquet")
    return path


def test_pipeline_stages_apply_their_decisions(spark, folder):
    import corpus_pipeline

    assert [f.__name__ for _, f in corpus_pipeline.STAGES] == ["keep_good", "drop_near_duplicates", "cut_repeated_passages", "drop_contaminated", "pack_sequences"]
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    columns = docs.columns
    kept = {x.doc_id for x in quality.quality_verdicts(docs).collect() if x.kept}
    one = stages.keep_good(spark, docs, folder)
    assert one.columns == columns and {x.doc_id for x in one.collect()} == kept and one.where("extra <> 'kept along'").count() == 0
    two = stages.drop_near_duplicates(spark, one, folder)
    rows = [(x.doc_id, x.text) for x in two.collect()]
    ids = [i for i, _ in rows if i is not None]
    assert two.columns == columns and len(ids) == len(set(ids))
    sets = [shingles(t) for i, t in rows if i is not None]
    assert not any(100 * len(a & b) >= 75 * len(a | b) for k, a in enumerate(sets) for b in sets[k + 1 :] if a)
    three = stages.cut_repeated_passages(spark, two, folder)
    left = [(x.doc_id, x.text, x.n_chars) for x in three.collect()]
    want = {i: h for i, _, n, h in brute_passages(rows)}
    before = dict(rows)
    assert three.columns == columns and len(left) == len(rows)
    for i, t, n in left:
        assert hashlib.sha256(" ".join(WORD.findall(t)).encode()).hexdigest() == want[i]
        assert t == before[i] or n == len(t)
    four = stages.drop_contaminated(spark, three, folder)
    leaks = brute_leaks([(i, t) for i, t, _ in left], [(1, "kilo lima mike november oscar papa quebec romeo. sierra tango uniform victor")])
    assert leaks and {x.doc_id for x in four.collect()} == {i for i, _, _ in left} - {i for i, _ in leaks} and four.columns == columns
    run = corpus_pipeline.run(spark, folder)
    assert {x.doc_id for x in run.collect()} == {x.doc_id for x in four.collect()}


def test_pipeline_on_an_empty_table(spark, folder, tmp_path):
    import corpus_pipeline

    spark.read.parquet(f"{folder}/documents.parquet").limit(0).write.parquet(f"{tmp_path}/documents.parquet")
    spark.read.parquet(f"{folder}/benchmark.parquet").write.parquet(f"{tmp_path}/benchmark.parquet")
    assert corpus_pipeline.run(spark, str(tmp_path)).collect() == []
