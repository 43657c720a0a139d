"""Trained operators, mixing, extraction, search and the pipeline on small inputs."""

from __future__ import annotations

import random

import numpy as np
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from tessera.llm import ann, classifier, html, language, mixing, toxicity

DOCS = "doc_id long, text string, lang string, source string, n_chars long"
SF = "/root/testdata/sf0.001"


def docs_of(spark, rows):
    return spark.createDataFrame([(i, t, lang, src, len(t or "")) for i, t, lang, src in rows], DOCS)


EN = "the cat and the dog were walking with their owner through the green park in the morning "
FR = "le chat et le chien se promenaient avec leur maître dans le parc près de la rivière "


@pytest.fixture(scope="module")
def bilingual(spark):
    rows = [(i, (EN if i % 2 else FR) * (1 + i % 3), "en" if i % 2 else "fr", f"s{i % 3}") for i in range(60)]
    return docs_of(spark, rows + [(100, None, None, None), (101, "", "en", "s0"), (102, "123 !!", "fr", None), (None, EN, "en", "s1"), (1, EN, "en", "s1")])


def test_language_edges(spark, bilingual):
    got = language.identify(bilingual.withColumn("score", F.lit("x")), language.fit(bilingual)).collect()
    assert len(got) == bilingual.count()
    by_id = {r.doc_id: r for r in got}
    assert all(by_id[i].lang_pred == ("en" if i % 2 else "fr") for i in range(60))
    assert [by_id[i].lang_pred for i in (100, 101, 102)] == ["und"] * 3
    assert by_id[None].lang_pred == "en" and not by_id[None].held_out
    assert all(0 <= r.score <= 1 for r in got)


def test_language_without_training_rows(spark):
    none = docs_of(spark, [(1, EN, None, "a")])
    assert language.fit(none) is None
    assert [r.lang_pred for r in language.identify(none, None).collect()] == ["und"]
    assert language.identify(none.limit(0), None).count() == 0


def test_language_held_out(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    got = language.identify(docs, language.fit(docs)).join(docs, "doc_id").where("held_out")
    right, n = got.agg(F.sum((F.col("lang") == F.col("lang_pred")).cast("int")), F.count("*")).first()
    assert right >= 0.95 * n


def test_share_out_redistributes_to_siblings():
    assert mixing.share_out(10, [2, 100, 100], [1, 1, 2]) == pytest.approx([2, 8 / 3, 16 / 3])
    assert mixing.share_out(50, [2, 3], [1, 1]) == [2, 3]
    assert mixing.share_out(0, [2], [1]) == [0]


def test_budgets_siblings_before_ancestors():
    mix = mixing.Mix(weights={("a",): 1, ("b",): 1, ("a", "x"): 1, ("a", "y"): 1, ("b", "z"): 1}, max_epochs=1)
    got = mixing.budgets({("a", "x"): 10, ("a", "y"): 100, ("b", "z"): 100}, mix, 100)
    assert got == pytest.approx({("a", "x"): 10, ("a", "y"): 40, ("b", "z"): 50})
    got = mixing.budgets({("a", "x"): 10, ("a", "y"): 20, ("b", "z"): 100}, mix, 100)
    assert got == pytest.approx({("a", "x"): 10, ("a", "y"): 20, ("b", "z"): 70})
    assert mixing.budgets({}, mix, 5) == {}


def test_leaves_of_equal_size_have_equal_targets():
    sizes = {("a", "x"): 100, ("b", "x"): 100, ("b", "y"): 100, ("b", "z"): 800}
    got = mixing.budgets(sizes, mixing.Mix(flatten=0.5), 500.0)
    assert got["a", "x"] == pytest.approx(got["b", "x"]) == pytest.approx(got["b", "y"])
    assert sum(got.values()) == pytest.approx(500) and got["b", "z"] / got["b", "x"] == pytest.approx(8**0.5)
    got = mixing.budgets(sizes, mixing.Mix(weights={("a",): 1, ("b",): 3, ("b", "z"): 0}), 400.0)
    assert got["a", "x"] == pytest.approx(100) and got["b", "x"] == pytest.approx(150) and got["b", "z"] == 0


@pytest.mark.parametrize("bucket_rows", [3, 1_000])
def test_mixing_against_brute_force(spark, monkeypatch, bucket_rows):
    monkeypatch.setattr(mixing, "BUCKET_ROWS", bucket_rows)
    rng = random.Random(3)
    rows = [(i, rng.randint(1, 30), rng.choice(["a", "a", "a", "b", None])) for i in range(80)]
    frame = spark.createDataFrame(rows, "key long, tokens long, level string")
    mix = mixing.Mix(weights={("a",): 1, ("b",): 2, (mixing.NONE,): 1}, budget=0.9, max_epochs=3)
    got = mixing.select_rows(frame, ["level"], mix)
    totals = {leaf: sum(t for _, t, x in rows if (x or mixing.NONE) == leaf) for leaf in ("a", "b", mixing.NONE)}
    budget = mixing.budgets({(k,): v for k, v in totals.items()}, mix, 0.9 * sum(totals.values()))
    want = set()
    for (leaf,), most in budget.items():
        whole = min(3, int(most // totals[leaf] + 1e-9))
        drawn = frame.selectExpr("key", "tokens", f"coalesce(level, '{mixing.NONE}') leaf", f"pmod(xxhash64({mix.seed}, {whole}, key), {1 << 30}) d")
        at = 0
        for r in sorted(drawn.where(F.col("leaf") == leaf).collect(), key=lambda r: (r.d, r.key)):
            times = whole + (whole < 3 and at < int(most - whole * totals[leaf] + 1e-6))
            want |= {(r.key, e) for e in range(times)}
            at += r.tokens
    assert {(r.key, r.epoch) for r in got.collect()} == want
    assert mixing.select_rows(frame.limit(0), ["level"], mix).count() == 0


def test_mixed_docs_keep_columns_and_copies(spark, bilingual):
    mix = mixing.Mix(flatten=1.0, budget=1.0, max_epochs=1)
    wide = bilingual.withColumn("tokens", F.lit(1)).withColumn("epoch", F.lit("z"))
    got = mixing.mixed_docs(wide, mix)
    assert got.columns == wide.columns
    assert got.exceptAll(wide).count() == 0 and got.count() >= 0.95 * wide.count()


def test_toxic_grammar():
    plain, aimed = toxicity.features("what an idiot."), toxicity.features("you are an idiot.")
    assert aimed[1] > plain[1] > 0
    assert toxicity.features("you are not an idiot.")[1] < plain[1]
    assert toxicity.features("he said idiot.")[1] < aimed[1]
    assert toxicity.features("I will kill you")[1] > 0
    assert toxicity.features("they kill time") == toxicity.features(None) == toxicity.features("") == (0, 0, 0)
    assert toxicity.features("un blorgo feo", frozenset({"blor"}))[1] > 0


def test_composition_is_the_cascade():
    rng = random.Random(1)
    a, b = toxicity.machine(4, toxicity._threat), toxicity.machine(3, toxicity._negation)
    both = toxicity.compose(a, b)
    for _ in range(200):
        p = q = r = 0
        for s in rng.choices(toxicity.SYMBOLS, k=9):
            p, mid, wa = a.arcs[p, s]
            q, out, wb = b.arcs[q, mid]
            r, got, w = both.arcs[r, s]
            assert (got, w) == (out, wa + wb)


@pytest.mark.parametrize("text", ["I'll kill you", "I’ll kill you", "I'd kill you", "I'm going to kill you", "I want to kill you", "We would hurt them", "kill yourself", "Go hang yourself!"])
def test_toxic_threats(text):
    assert toxicity.features(text)[1] >= 1.5


@pytest.mark.parametrize("text", ["I hope you die", "I wish they were dead", "go to hell", "fuck you", "you are trash", "you piece of shit"])
def test_toxic_idioms(text):
    assert toxicity.features(text)[1] >= 1.0


@pytest.mark.parametrize("text", ["they took out the trash", "we empty the garbage", "the battery may die", "hell of a ride", "hope is the last to die", "we go there", "they burn wood", "rot und hell", "he suffers", ""])
def test_plain_idioms(text):
    assert toxicity.features(text) == (0, 0, 0)


def test_toxic_threats_negated_reported_and_nouns():
    plain = toxicity.features("I want to kill you")[1]
    for text in ("I don't want to kill you", "I'm not going to kill you", "I won't kill you", "They can't ever hurt you"):
        assert toxicity.features(text)[1] < plain
    assert toxicity.features("the attack you saw") == toxicity.features("we beat time") == (0, 0, 0)
    aimed = toxicity.features("you idiot")[1]
    for text in ("He said: you idiot", 'He said:\n"you idiot"', 'He said: "You there! you idiot"'):
        assert toxicity.features(text)[1] < aimed
    for text in ("He said so. you idiot", "Note: you idiot", 'He said: "Hello." you idiot', 'He said "hello\nyou idiot'):
        assert toxicity.features(text)[1] == aimed


def test_toxic_contexts_are_learned(spark):
    rows = [(f"number {'x' * k} we hereby kill everybody", 1.0) for k in range(8)] + [(f"number {'x' * k} hereby greet everybody", 0.0) for k in range(8)]
    learned = toxicity.learn_insults(spark.createDataFrame(rows, "text string, y double"), toxicity.Settings())
    assert {"<hereby", ">everybody"} <= learned
    assert toxicity.features("they hereby kill time") == (0, 0, 0) != toxicity.features("they hereby kill time", learned)
    assert toxicity.features("hereby to everybody", learned) == (0, 0, 0)


def test_toxicity_edges(spark):
    docs = docs_of(spark, [(1, "you idiot", "en", "a"), (2, None, None, None), (2, "fine", "en", "a"), (None, "you idiot", "en", "a"), (3, "", "en", "a")])
    labels = spark.createDataFrame([(1, 1), (2, None), (None, 1), (3, 0), (3, 0)], "doc_id long, toxic int")
    for some in (labels, labels.limit(0)):
        got = {(r.doc_id, r.predicted) for r in toxicity.score(docs, some).collect()}
        assert {i for i, _ in got} == {1, 2, 3, None}
    assert {(1, 1), (None, 1), (3, 0), (2, 0)} == got
    assert toxicity.score(docs.limit(0), labels).count() == 0


def test_html_structure():
    page = (
        "<html><head><title>T</title><style>p{}</style><script>var a='</p><p>x';</script></head><body><nav><a>Menu</a></nav><!-- c --><div class='ad'>Buy"
        "</div><article><h1>A &amp; B</h1><p>One <b>two</b>\n three<br>four<p>Five&nbsp;six<div class='user-comments'><p>Troll</p></div></article><footer>Foot"
    )
    assert html.main_texts([html.blocks(page)], 8) == ["A & B\nOne two three four\nFive six"]
    assert html.main_texts([html.blocks(None), html.blocks(""), html.blocks("<nav>a</nav>")], 8) == ["", "", ""]


def test_html_raw_elements_end():
    def text(html_text):
        return html.main_texts([html.blocks(html_text)], 8)[0]

    assert text("<html><head><title>T</title><meta charset=x><style>p{}</style><body><p>One</p><p>Two</p></body>") == "One\nTwo"
    assert text("<head><title>T</title><article><h1>One</h1><p>Two</article>") == "One\nTwo"
    assert text("<head><title>T<body><p>One") == "One"
    for tag in ("svg", "iframe", "object", "noscript", "template", "script", "canvas"):
        for made in (f"<{tag}/>", f"<{tag} a='b' />", f'<{tag} src="x/y"/>'):
            assert text(f"<article><p>One {made} two</p><p>three</p><{tag}>{'' if tag in ('object', 'canvas') else 'gone'}</{tag}><p>four</p></article>") == "One two\nthree\nfour"
    assert text("<p>One<script src=/a/></script></p><p>two<iframe src=http://a.example/>no</iframe></p>") == "One\ntwo"
    assert text("<article><p>One</p><svg><p>two</p><iframe src='x'><p>three</p></article>") == "One\ntwo\nthree"
    assert text("<p>One</p><script>var a = 1;") == "One"
    formula = "<math><mfrac><mn>1</mn><mn>2</mn></mfrac></math>"
    assert text(f"<article><p>Half is {formula}, <object data='x'><param name=a>a chart</object> <canvas>a plot</canvas></p></article>") == "Half is 1 2, a chart a plot"
    assert text("<article><video controls><source src='a'><p>A talk</p></video><audio>A song</audio></article>") == "A talk\nA song"


def test_html_host_boilerplate(spark):
    note = "this site needs your help to keep running so please give"
    pages = [(k, f"http://h.example/{k}", f"<body><p>{note}</p><p>story number {k} about {'x' * (k + 1)} things</p></body>") for k in range(3)]
    pages += [(7, "http://other.example/", f"<body><p>{note}</p></body>"), (8, None, None), (9, "http://h.example/a", f"<article><p>{note}</p></article>"), (9, "http://h.example/a", f"<article><p>{note}</p></article>")]
    frame = spark.createDataFrame(pages, "page_id long, url string, html string").withColumn("text", F.lit("clash")).withColumn("host", F.lit(1))
    for shard in (2_000, 6):
        got = {r.page_id: r.text for r in html.extract(frame, html.Settings(shard=shard)).collect()}
        assert got[7] == note and got[8] == "" and got[9] == note
    assert {r.page_id: r.text for r in html.extract(frame).collect()}[1] == "story number 1 about xx things"
    assert html.extract(frame).count() == 7 and html.extract(frame.limit(0)).count() == 0


def test_html_articles_stay_whole():
    head, close = "Nine words of a heading that an advert also quotes", "and so ends this long story about the green river"
    story = f"<article><h1>{head}</h1><p>Once there was a fish {close}</p></article>"
    plain = f"<p>{head}</p><p>only here</p>"
    pages = [story, f"<article><p>Other</p></article><div class=ad>{head}</div><footer>{close}</footer>", story, plain]
    got = html.main_texts([html.blocks(p) for p in pages], 8)
    assert got == [f"{head}\nOnce there was a fish {close}", "Other", f"{head}\nOnce there was a fish {close}", "only here"]


def test_html_shards_do_not_change_texts(spark):
    lead, sold = "every story of this site begins with the same ten words", "buy two of our fine green garden chairs today and save"
    pages = [(k, f"http://h.example/{k}", f"<body><p>{lead if k in (3, 17) else ''} tale {'x' * (k + 1)} told</p></body>") for k in range(24)]
    pages += [(30 + k, f"http://h.example/s{k}", f"<article><p>Once {k} {sold} {'y' * (k + 1)}</p></article>") for k in range(3)]
    pages += [(40, "http://h.example/f", f"<article><p>short</p></article><footer>{sold}</footer>"), (41, "http://one.example/", f"<p>{lead}</p>")]
    pages += [(50, "http://h.example/same", "<body><p>the very same page is here for a second time again</p></body>")] * 2
    pages += [(60 + k, f"http://articles.example/{k}", f"<article><p>Tale {k} {sold}</p></article><footer>{sold}</footer>") for k in range(7)]
    frame = spark.createDataFrame(pages, "page_id long, url string, html string")
    want = sorted(tuple(r) for r in html.extract(frame).collect())
    assert {r[0]: r[2] for r in want}[3] == "xxxx told" and {r[0]: r[2] for r in want}[41] == lead
    for shard, broadcast in ((5, 100_000), (1, 100_000), (5, 0)):
        assert sorted(tuple(r) for r in html.extract(frame, html.Settings(shard=shard, broadcast_hosts=broadcast)).collect()) == want


def test_suffix_ranks_against_brute_force():
    rng = np.random.default_rng(0)
    x = rng.integers(0, 3, 200)
    ranks = html.suffix_ranks(x, 5)
    want = [tuple(x[i : i + 5].tolist()) for i in range(200)]
    order = sorted(set(want))
    assert ranks.tolist() == [order.index(w) for w in want]


@pytest.mark.parametrize("pending", [0, 40, 10**6])
def test_best_of_a_block_against_a_sort(monkeypatch, pending):
    import pyarrow as pa

    monkeypatch.setattr(ann.Best, "PENDING", pending)
    monkeypatch.setattr(ann.Best, "TILE", 3)
    rng = np.random.default_rng(2)
    x, y = rng.integers(-2, 3, (7, 3)).astype(float), rng.integers(-2, 3, (60, 3)).astype(float)
    homes = np.column_stack([rng.integers(0, 4, 60), rng.integers(4, 8, 60)])
    visited = [[0, 5], [1, 2, 4], [], [3], list(range(8)), [7], [0, 1]]
    best = ann.Best(5, 8)
    for part in (slice(0, 4), slice(4, 7)):
        best.ask(100 + np.arange(7)[part], x[part], pa.array(visited[part], pa.list_(pa.int32())))
    for i in range(0, 60, 11):
        best.offer(np.arange(60)[i : i + 11], y[i : i + 11], homes[i : i + 11])
    got = {}
    for q, c, s in zip(*best.rows()):
        got.setdefault(int(q) - 100, []).append((-s, int(c)))
    for q, seen in enumerate(visited):
        want = sorted((-float(x[q] @ y[c]), c) for c in range(60) if set(homes[c]) & set(seen))[:5]
        assert got.get(q, []) == want


def test_nearest_exact_when_all_leaves_are_visited(spark):
    rng = np.random.default_rng(5)
    x = rng.standard_normal((300, 8)).round(2) * rng.uniform(0.5, 2, (300, 1))
    x[50:120] = x[50]
    rows = [(i, v.tolist()) for i, v in enumerate(x)]
    rows += [(400, None), (420, [0.0] * 8), (440, [1.0, None] + [1.0] * 6), (460, [float("nan")] * 8), (480, [1.0, 2.0]), (None, [1.0] * 8)]
    frame = spark.createDataFrame(rows, "vec_id long, embedding array<double>").withColumn("score", F.lit(1))
    got = ann.nearest(frame, F.col("vec_id") % 20 == 0, 20, ann.Settings(leaf=32, probe=1.0))
    found = {}
    for r in got.collect():
        found.setdefault(r.query_id, []).append((r.rank, r.vec_id, r.score))
    assert sorted(found) == list(range(0, 300, 20))
    for q, hits in found.items():
        s = x @ x[q]
        want = sorted((round(-s[i], 9), i) for i in range(300) if i != q)[:20]
        assert [h[1] for h in sorted(hits)] == [i for _, i in want]
        assert [h[2] for h in sorted(hits)] == pytest.approx([-s for s, _ in want], abs=1e-8)
    assert ann.nearest(frame.limit(0), F.col("vec_id") % 20 == 0).count() == 0
    assert ann.nearest(frame.where("vec_id < 3"), F.col("vec_id") % 20 == 0).count() == 2


def test_classifier_votes_and_edges(spark, bilingual):
    junk = docs_of(spark, [(200 + i, "BUY### NOW$$$ %%% !!! ### CLICK&&& " * 8, "en", "j") for i in range(12)])
    docs = bilingual.unionByName(junk)
    got = {r.doc_id: r for r in classifier.classify(docs, classifier.fit(docs)).collect()}
    assert all(got[i].kept for i in range(60)) and not any(got[200 + i].kept for i in range(12))
    assert not got[100].kept and not got[101].kept
    assert classifier.fit(docs.limit(0)) is None and classifier.classify(docs.limit(0), None).count() == 0
    kept = classifier.keep_good(docs, classifier.fit(docs))
    assert kept.columns == docs.columns and kept.count() == sum(r.kept for r in classifier.classify(docs, classifier.fit(docs)).collect())


def test_classifier_on_labelled_documents(spark):
    """Labels are not used in training, so all labelled documents are held out."""
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    marked = spark.read.parquet("/root/testdata/sf0.01/labels.parquet")
    got = classifier.classify(docs, classifier.fit(docs)).join(marked, "doc_id").select("quality", "kept").collect()
    bad, good = ([r.kept for r in got if r.quality == q] for q in (0, 1))
    assert sum(bad) <= 0.2 * len(bad) and sum(good) >= 0.98 * len(good) and len(bad) > 30


def test_classifier_sample_of_repeated_rows(spark, bilingual, monkeypatch):
    """A sample keeps its bound where one row is most of the table, and is drawn where all rows are copies."""
    sizes = []
    fit = classifier.fit_logistic
    monkeypatch.setattr(classifier, "fit_logistic", lambda x, y, **k: (sizes.append(len(x)), fit(x, y, **k))[1])
    copies = docs_of(spark, [(7, EN * 3, "en", "s0")] * 3_000)
    for docs in (bilingual.unionByName(copies), copies):
        model = classifier.fit(docs, classifier.Settings(sample=40))
        assert model is not None and 0 < sizes[-1] <= 70
        assert all(r.kept for r in classifier.classify(docs, model).where("doc_id = 7").distinct().collect())


def test_classifier_votes_on_repeats_and_menus():
    vote = dict(zip(classifier.LABELLERS, classifier.votes(EN + "blah " * 30)))
    assert vote["repeated words"] == vote["longest run"] == -1 and vote["lone separators"] == 1
    vote = dict(zip(classifier.LABELLERS, classifier.votes("Home | News | Sport | Shop | Contact | Terms " * 8)))
    assert vote["lone separators"] == vote["signs"] == vote["no function words"] == -1 and vote["longest run"] == 1
    assert set(classifier.votes(EN + FR)[-4:]) == {1} and set(classifier.votes(None)) == {-1}


def test_posteriors_follow_the_majority():
    p = classifier.posteriors({(1, 1, 1): 80, (-1, -1, -1): 15, (1, -1, 1): 3, (-1, 1, -1): 2})
    assert p[1, 1, 1] > 0.9 > 0.5 > p[-1, -1, -1] and p[1, -1, 1] > p[-1, 1, -1]
    assert classifier.posteriors({}) == {}


def test_pipeline_stages(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    assert [n for n, _ in corpus_pipeline.STAGES] == ["quality_rules", "quality_classifier", "simhash_near_dedup", "mix_sources", "best_fit_packing"]
    for _, stage in corpus_pipeline.STAGES[:-1]:
        after = stage(spark, docs, SF)
        assert after.columns == docs.columns
        assert 0 < after.count()
    out = corpus_pipeline.run(spark, SF)
    full = out.groupBy("sequence_id").agg(F.sum("length").alias("n"), F.max(F.col("offset") + F.col("length")).alias("end"))
    assert full.where("n > 4096 or n != end").count() == 0 and out.count() > 0


LONG = " ".join(f"{w} and word{k}." for k, w in enumerate(("the river of the town " * 4_000).split()))


def odd_documents(spark):
    """Nulls, ties, repeated rows, a very long text, texts without a word, and extra columns with clashing names."""
    rng = random.Random(4)
    prose = [" ".join(rng.choice(EN.split()) + rng.choice(("", "s", "ly")) for _ in range(80)) + "." for _ in range(12)]
    rows = [(k, t, "en", f"s{k % 2}") for k, t in enumerate(prose)]
    rows += [rows[0], rows[0], (0, prose[1], "en", "s0"), (20, prose[2], "en", None), (None, prose[3], None, "s1"), (None, prose[4] + " then", None, None)]
    rows += [(30, None, None, None), (30, None, "en", "s0"), (31, "", "en", "s0"), (32, " \n\t", "en", "s0"), (33, LONG, "en", "s0")]
    docs = docs_of(spark, rows)
    for name in ("id", "fp", "label", "tokens", "epoch", "score", "kept", "key", "copy", "rank", "length", "sequence_id"):
        docs = docs.withColumn(name, F.lit("x"))
    return docs


def test_stages_on_odd_rows(spark):
    docs = odd_documents(spark)
    for name, stage in corpus_pipeline.STAGES[:-1]:
        after = stage(spark, docs, SF)
        assert after.columns == docs.columns and after.schema.simpleString() == docs.schema.simpleString(), name
        got = after.collect()
        assert got and all(r.id == "x" and r.sequence_id == "x" for r in got), name
        if name in ("quality_rules", "quality_classifier"):
            assert all((r.text or "").strip() for r in got), name
        if name == "quality_rules":
            assert [r.text for r in got if r.doc_id == 33] == [LONG]
        if name == "simhash_near_dedup":
            ids = sorted(-1 if r.doc_id is None else r.doc_id for r in got)
            assert ids.count(0) <= 2 and ids.count(30) == 1 and not {31, 32} & set(ids)
        assert stage(spark, docs.limit(0), SF).count() == 0, name


@pytest.mark.parametrize("empty", [False, True])
def test_pipeline_on_odd_rows(spark, tmp_path, empty):
    docs = odd_documents(spark)
    (docs.limit(0) if empty else docs).write.parquet(f"{tmp_path}/documents.parquet")
    out = corpus_pipeline.run(spark, str(tmp_path)).select("doc_id", "sequence_id", "offset", "length", "piece").collect()
    assert bool(out) != empty
    places = {}
    for r in out:
        places.setdefault(r.sequence_id, []).append((r.offset, r.length))
    for pieces in places.values():
        end = 0
        for offset, length in sorted(pieces):
            assert offset == end
            end += length
        assert end <= 4096
    assert empty or len({r.piece for r in out if r.doc_id == 33}) > 1


def test_words_of_a_mix(spark):
    texts = [None, "", " \t\n", "one", " two\x0bwords ", "x xx\r\n\x0cé\xa0é 日本", "w " * 50_000 + "end"]
    frame = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, t string")
    got = [r[0] for r in frame.orderBy("i").select(mixing.words(F.col("t"))).collect()]
    assert got == [1, 1, 1, 2, 3, 5, 50_002]
