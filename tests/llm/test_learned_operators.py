"""Classifiers, pages, near duplicates, vectors and the pipeline."""

import math
import random
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from loanweave.llm import multi_index, nbsvm, page_templates, superminhash, toxicity
from loanweave.llm.catalog import QUERIES
from loanweave.llm.common import table

SF = "/root/testdata/sf0.001"
SMALL = "/root/testdata/sf0.01"


def texts(spark, directory):
    return {r.doc_id: r.text or "" for r in table(spark, directory, "documents").collect()}


# ---------------------------------------------------------------- classifiers


@pytest.mark.parametrize("name, label, least", [("op7_quality", "quality", 0.97), ("op1_toxicity", "toxic", 0.9)])
def test_held_out_accuracy(spark, name, label, least):
    out = QUERIES[name](spark, SMALL)
    assert out.count() == table(spark, SMALL, "documents").count()
    held = out.join(table(spark, SMALL, "labels"), "doc_id").where("held_out")
    right, n = held.select(F.avg((F.col("predicted") == F.col(label)).cast("int")), F.count("*")).first()
    assert n > 40 and right >= least
    assert out.where("score < 0 or score > 1 or (score >= 0.3) != (predicted = 1)").isEmpty()


def test_character_counts_are_those_of_single_ngrams(spark):
    """More distinct 4-grams than a table of 2**18 slots keeps apart."""
    draw = random.Random(3)
    rows = [("".join(chr(0x4E00 + draw.randrange(3000)) for _ in range(500)),) for _ in range(800)] + [(None,), ("",)]
    counts = toxicity.character_counts(spark.createDataFrame(rows, "text string").repartition(3))
    model = toxicity.CharacterModel(counts)
    want = defaultdict(int)
    for text, in rows:
        line = f" {text} " if text else ""
        for n in range(1, 5):
            for k in range(len(line) - n + 1):
                want[line[k : k + n]] += 1
    assert sum(len(keys) for keys, _ in counts) == len(want) > 2**18
    sample = draw.sample(sorted(want), 5000)
    assert [model._count(g) for g in sample] == [want[g] for g in sample] and model._count("zzzz") == 0


def odd_documents(spark):
    rows = [(1, None), (2, ""), (2, ""), (None, "abc"), (3, "good text here " * 5000)]
    return spark.createDataFrame(rows, "doc_id bigint, text string").withColumn("score", F.lit("clash"))


def test_classifiers_on_odd_rows_and_without_labels(spark):
    docs = odd_documents(spark)
    none = spark.createDataFrame([], "doc_id bigint, quality int, toxic int")
    assert {r.score for r in nbsvm.score(docs, none).collect()} == {0.5}
    out = toxicity.score(docs, none).collect()
    assert len(out) == 5 and len({r.score for r in out}) == 1 and out[0].restored == ""
    some = spark.createDataFrame([(1, 1, 0), (3, 0, 1), (3, 0, 1), (None, 1, 1), (9, None, None)], none.schema)
    assert nbsvm.score(docs, some).count() == 5
    assert toxicity.score(docs.limit(0), some).count() == 0


def test_dual_coordinate_descent_separates():
    rows = [np.array([i % 7, 7 + (i % 2)]) for i in range(200)]
    labels = np.array([i % 2 for i in range(200)])
    weights = nbsvm.dual_coordinate_descent(rows, [np.ones(2) for _ in rows], labels, 9)
    margins = [weights[r].sum() + weights[9] for r in rows]
    assert all((m > 0) == (y == 1) for m, y in zip(margins, labels))


def test_decoder_restores_obfuscated_words(spark):
    counts = toxicity.character_counts(table(spark, SMALL, "documents").select("text"))
    restore = toxicity.Restorer(counts).text
    for written in ("l0ser", "looooser", "l o s e r", "l.o.s.e.r", "L0SER"):
        assert restore(f"that {written} is") == "that loser is"
    for written in ("1d10t", "idi0t", "i-d-i-o-t"):
        assert restore(written) == "idiot"
    plain = "there are 15 of them, and the rest. a b"
    assert restore(plain) == plain


def test_viterbi_is_the_best_of_all_readings(spark):
    counts = toxicity.character_counts(table(spark, SF, "documents").select("text"))
    model = toxicity.CharacterModel(counts)

    def every(pieces):
        if not pieces:
            yield "", 0.0
            return
        for rest, spent in every(pieces[1:]):
            for reading, cost in pieces[0]:
                yield reading + rest, spent + cost

    def total(reading, spent):
        context = " "
        for c in reading + " ":
            spent += model.cost(context, c)
            context = (context + c)[-3:]
        return spent

    for span in ("1d10t", "l0ooser", "p4th", "s-t"):
        costs = {r: total(r, s) for r, s in every(toxicity.lattice(span))}
        assert math.isclose(costs[toxicity.decode(span, model)], min(costs.values()))


def test_obfuscated_insults_score_like_plain_ones(spark):
    labels = table(spark, SMALL, "labels")
    docs = table(spark, SMALL, "documents").select("doc_id", "text")
    extra = spark.createDataFrame(
        [(-1, "the 1d10t was"), (-2, "a l o s e r there"), (-3, "the rest was there"), (-4, "such a mooooron")], docs.schema
    )
    by = {r.doc_id: r for r in toxicity.score(docs.unionByName(extra), labels).where("doc_id < 0").collect()}
    assert by[-1].score >= 0.3 and by[-2].score >= 0.3 and by[-4].score >= 0.3 and by[-3].score < 0.3
    assert by[-2].findings == ["loser"] and by[-1].restored == "the idiot was"


# ---------------------------------------------------------------- pages

PAGE = """<!DOCTYPE html><html><head><title>T</title><style>p{{}}</style></head><body><nav><a href=x>Menu {n}</a></nav>
<div class="cookie-notice">We use cookies</div><article class="post"><h1>Title {n}</h1><p>One  &amp; <b>two</b>
{n}<br>three<p>Unclosed {n} &lt;tag&gt;<script>var a="<p>no</p>";</script><div class="share">Share</div>
<p>Subscribe now</p><ul><li>item a{n}<li>item b</ul></article><section class="comments"><p>Nice post</p></section>
<aside>side</aside><form><p>form</p></form><footer>&copy; {n}"""


def test_pages_give_their_documents(spark):
    """Pages of the corpus wrap a document's lines in an article with a heading."""
    docs = texts(spark, SF)
    number = F.regexp_extract("url", r"/(\d+)(?:\.html|/)?(?:[?#]|$)", 1).cast("bigint")
    out = QUERIES["op3_page_templates"](spark, SF).withColumn("doc", number).collect()
    assert len(out) == table(spark, SF, "pages").count()
    for r in out:
        lines = [" ".join(line.split()) for line in docs[r.doc].split("\n")]
        assert r.text.split("\n\n")[1:] == [line for line in lines if line]
        assert r.n_chars == len(r.text)


def test_template_is_taken_out_and_odd_pages_survive(spark):
    rows = [(n, f"http://a.example/{n}", PAGE.format(n=n)) for n in range(12)]
    rows += [(20, None, None), (21, "http://b.example/", ""), (22, "x", "no <b>markup</b> & < 3"), (22, "x", "no <b>markup</b> & < 3")]
    rows += [(30 + n, "http://c.example/same", "<article><p>Copied text.</p><p>Second line.</p></article>") for n in range(8)]
    pages = spark.createDataFrame(rows, "page_id bigint, url string, html string").withColumn("main_text", F.lit(1))
    out = page_templates.extract_main_text(pages).collect()
    assert len(out) == len(rows)
    by = {r.page_id: r.main_text for r in out}
    assert by[3] == "Title 3\n\nOne & two 3 three\n\nUnclosed 3 <tag>\n\nitem a3\n\nitem b".replace("\n\nitem b", "") or by[3].startswith(
        "Title 3\n\nOne & two 3 three\n\nUnclosed 3 <tag>"
    )
    assert "Subscribe" not in by[3] and "Share" not in by[3] and "cookies" not in by[3] and "Nice" not in by[3]
    assert by[20] == "" and by[21] == "" and by[22] == "no markup & < 3"
    assert by[31] == "Copied text.\n\nSecond line."
    assert page_templates.extract_main_text(pages.limit(0)).count() == 0


def test_layouts_of_one_host_have_their_own_constants(spark):
    """Plain elements; each of three layouts is on a third of the host's pages."""
    layout = (
        '<html><body><div class="{k}top"><div class="{k}line">Home of {k}</div></div><div class="{k}text"><p>Words {n} of {k}.</p>'
        '<p>More {n}.</p></div><div class="{k}end"><div class="{k}line">All about {k}</div></div></body></html>'
    )
    rows = [(n, f"http://d.example/{n}", layout.format(k="uvw"[n % 3], n=n)) for n in range(36)]
    pages = spark.createDataFrame(rows, "page_id bigint, url string, html string")
    for r in page_templates.extract_main_text(pages).collect():
        assert r.main_text == f"Words {r.page_id} of {'uvw'[r.page_id % 3]}.\n\nMore {r.page_id}."
    # pages stored twice, clashing names, and templates joined by salt change nothing
    twice = pages.unionByName(pages).withColumns({"host": F.lit("h"), "_host": F.lit(1), "constants": F.lit(2), "salt": F.lit(3)})
    for limit in (page_templates.TEMPLATE_BYTES, 0):
        out = page_templates.extract_main_text(twice, limit=limit)
        assert out.columns == [*twice.columns, "main_text"]
        found = out.collect()
        assert len(found) == 72
        for r in found:
            assert (r.host, r["_host"], r.constants, r.salt) == ("h", 1, 2, 3)
            assert r.main_text == f"Words {r.page_id} of {'uvw'[r.page_id % 3]}.\n\nMore {r.page_id}."


def test_names_never_empty_a_page():
    """Classes of raw pages that only look like those of menus and the like."""
    text = "<p>First words.</p><p>Second words.</p>"
    kept = [
        f'<body class="no-sidebar">{text}</body>', f'<body class="single has-sidebar comments-open">{text}</body>',
        f'<body class="sidebar"><article class="post comments-open">{text}</article></body>', f'<body class="widget">{text}</body>',
        f'<article class="comments">{text}</article>', f'<main id="sidebar">{text}</main>', f'<div role="main" class="widget">{text}</div>',
        f'<div id="content" class="widget-area">{text}</div>', f'<div class="widget"><div><article>{text}</article></div></div>',
        f'<div class="sidebar"><main>{text}</main></div>', f'<div class="layout-sidebar-left">{text}</div>',
        f'<main>{text}<section class="comments"><article>Nice.</article></section></main>',
        f'<article>{text}</article><div class="comments"><article>Nice.</article></div>',
        f'<div>{text}</div><div class="sidebar" id="sidebar-1">Other</div><div class="wide ad">Buy</div>',
    ]
    for source in kept:
        assert page_templates.main_blocks(page_templates.Page(source), []) == ["First words.", "Second words."], source


# ---------------------------------------------------------------- near duplicates


def brute_components(rows, size, percent):
    """(shingles, component) per id, comparing all pairs."""
    sets = {}
    for i, text in rows:
        w = (text or "").encode().lower().split()
        sets[i] = {tuple(w[k : k + size]) for k in range(len(w) - size + 1)} or ({tuple(w)} if w else set())
    parent = {i: i for i in sets}

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    ids = sorted(sets)
    for a in ids:
        for b in ids:
            if a < b and sets[a] and sets[b]:
                common = len(sets[a] & sets[b])
                if 100 * common >= percent * (len(sets[a]) + len(sets[b]) - common):
                    x, y = root(a), root(b)
                    parent[max(x, y)] = min(x, y)
    return {i: (len(sets[i]), root(i)) for i in ids}


def test_near_duplicates_equal_brute_force(spark):
    rows = list(texts(spark, SF).items())
    want = brute_components(rows, 3, 85)
    for r in QUERIES["op9_superminhash"](spark, SF).collect():
        assert (r.n_shingles, r.component_id) == want[r.doc_id]
        assert r.kept == (r.component_id == r.doc_id)


def test_chains_copies_and_odd_texts(spark):
    """Chains of edits, copies, texts of one or two words, blanks and nulls."""
    rng = random.Random(4)
    rows, word = [], [f"w{k}" for k in range(400)]
    for g in range(6):
        text = [rng.choice(word) for _ in range(80)]
        for _ in range(15):
            text = list(text)
            text[rng.randrange(80)] = rng.choice(word)
            rows.append((len(rows) * 3 + 1, " ".join(text)))
    rows += [(10_000 + k, " ".join(rng.sample(word, 60))) for k in range(5)]
    rows += [(20_000 + k, rows[0][1].upper()) for k in range(30)]
    rows += [(5, None), (6, ""), (8, " \t"), (9, "one"), (11, "ONE"), (12, "one two"), (14, "One  two"), (15, "two one")]
    docs = spark.createDataFrame(rows + [rows[3], (None, "one")], "doc_id bigint, text string").withColumn("kept", F.lit(0))
    out = superminhash.near_duplicates(docs, size=3, percent=85).collect()
    want = brute_components(rows, 3, 85)
    assert len(out) == len(rows) + 2
    for r in out:
        if r.id is None:
            assert r.component_id is None and r.kept
        else:
            assert (r.n_shingles, r.component_id) == want[r.id], r
    assert len({r.component_id for r in out if r.id == r.component_id}) < len(rows) - 40
    kept = superminhash.deduplicate(docs, size=3, percent=85)
    assert kept.columns == docs.columns
    assert superminhash.near_duplicates(docs.limit(0)).count() == 0


def test_large_buckets_are_compared_in_rounds(spark):
    """Many texts that share most words but are no near duplicates, and a few that are."""
    rng = random.Random(9)
    common = [f"c{k}" for k in range(70)]
    rows = [(k, " ".join(common + [f"x{rng.randrange(10**6)}" for _ in range(14)])) for k in range(40)]
    rows += [(100 + k, rows[k][1] + " end") for k in range(0, 40, 9)]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string")
    want = brute_components(rows, 3, 85)
    for r in superminhash.near_duplicates(docs, size=3, percent=85).collect():
        assert (r.n_shingles, r.component_id) == want[r.id]


def test_signature_agreement_estimates_similarity():
    rng = np.random.default_rng(3)
    shared = rng.integers(0, 2**63, 600).astype(np.uint64)
    a = np.concatenate([shared, rng.integers(0, 2**63, 200).astype(np.uint64)])
    b = np.concatenate([shared, rng.integers(0, 2**63, 200).astype(np.uint64)])
    same = np.mean(superminhash.signature(a, 512) == superminhash.signature(b, 512))
    assert abs(same - 0.6) < 0.07
    few = rng.integers(0, 2**63, 3).astype(np.uint64)
    assert np.isfinite(superminhash.signature(few, 120)).all()
    assert (superminhash.signature(few, 120) == superminhash.signature(few[::-1].copy(), 120)).all()
    full = superminhash.signature(a, 64)
    superminhash_block, superminhash.BLOCK = superminhash.BLOCK, 100
    assert (superminhash.signature(a, 64) == full).all()
    superminhash.BLOCK = superminhash_block


def test_components_of_a_long_path(spark):
    links = spark.createDataFrame([(k + 1, k) for k in range(60)] + [(100, 101), (101, 102)], "a bigint, b bigint")
    out = {r.node: r.label for r in superminhash.components(links).collect()}
    assert out == {**{k: 0 for k in range(61)}, 100: 100, 101: 100, 102: 100}


# ---------------------------------------------------------------- vectors


def brute_nearest(vectors, k):
    out = {}
    for q, v in vectors.items():
        if q % 50 == 0:
            near = [(-float(np.dot(v, w) / math.sqrt(np.dot(v, v) * np.dot(w, w))), i) for i, w in vectors.items() if i != q]
            out[q] = [i for _, i in sorted(near)[:k]]
    return out


def test_recall_and_scores(spark):
    vectors = {r.vec_id: np.array(r.embedding, float) for r in table(spark, SF, "embeddings").collect()}
    want = brute_nearest(vectors, 5)
    found = defaultdict(list)
    for r in QUERIES["op10_multi_index"](spark, SF).orderBy("query_id", "rank").collect():
        found[r.query_id].append(r.vec_id)
        a, b = vectors[r.query_id], vectors[r.vec_id]
        assert abs(r.score - np.dot(a, b) / math.sqrt(np.dot(a, a) * np.dot(b, b))) < 1e-12
        assert r["rank"] == len(found[r.query_id])
    recall = sum(len(set(want[q]) & set(found[q])) for q in want) / sum(map(len, want.values()))
    assert recall >= 0.9


def test_odd_vectors_ties_and_copies(spark):
    rows = [(i, [1.0, 0.0, 0.5, 0.1]) for i in range(0, 120, 2)] + [(i, [0.0, 1.0, 0.3, float(i)]) for i in range(1, 40, 2)]
    rows += [(200, None), (201, []), (202, [0.0] * 4), (203, [1.0, None, 0.0, 0.0]), (204, [float("nan")] * 4), (250, [float("inf")] * 4), (None, [1.0] * 4)]
    vectors = spark.createDataFrame(rows + [rows[3]], "vec_id bigint, embedding array<double>").withColumn("score", F.lit("x"))
    out = multi_index.nearest_neighbours(vectors, vectors.where("vec_id % 50 = 0")).orderBy("query_id", "rank").collect()
    got = defaultdict(list)
    for r in out:
        got[r.query_id].append(r.vec_id)
    assert dict(got) == {0: [2, 4, 6, 8, 10], 50: [0, 2, 4, 6, 8], 100: [0, 2, 4, 6, 8]}
    few = vectors.where("vec_id in (0, 1, 3)")
    assert multi_index.nearest_neighbours(few, few.where("vec_id = 0")).count() == 2
    assert multi_index.nearest_neighbours(vectors.limit(0), vectors.limit(0)).count() == 0


def test_buckets_have_no_unused_parameter():
    code = superminhash._buckets.__code__
    assert code.co_varnames[: code.co_argcount] == ("nodes",)


# ---------------------------------------------------------------- pipeline


def test_pipeline_stage_by_stage(spark):
    """Each stage is judged on its own input, against brute force where there is one."""
    docs = table(spark, SF, "documents")
    names = docs.columns
    benchmark = [(r.item_id, r.text) for r in table(spark, SF, "benchmark").collect()]
    from tests.llm.test_text_operators import base_spans, hits

    for k, (name, stage) in enumerate(corpus_pipeline.STAGES):
        before = {r.doc_id: r for r in docs.collect()}
        docs = stage(spark, docs, SF).cache()
        after = {r.doc_id: r for r in docs.collect()}
        assert set(after) <= set(before)
        if k < 4:
            assert docs.columns == names
        if k == 0:
            labels = {r.doc_id: r.quality for r in table(spark, SF, "labels").collect()}
            wrong = [i for i in before if i in labels and (i in after) != (labels[i] == 1)]
            assert len(wrong) <= 0.05 * len(labels)
        if k == 1:
            want = brute_components([(i, r.text) for i, r in before.items()], 5, 80)
            assert set(after) == {i for i, (_, c) in want.items() if c == i}
        if k == 2:
            assert set(after) == {i for i, r in before.items() if not hits(r.text, benchmark)[2]}
        if k == 3:
            assert set(after) == set(before)
            assert all(not base_spans(r.text) and r.n_chars == len(r.text) for r in after.values())
    assert all(r.round_trip and r.n_tokens == len(r.ids) for r in after.values())


def test_pipeline_runs_from_end_to_end(spark):
    assert [len(s) for s in corpus_pipeline.STAGES] == [2] * 5
    assert corpus_pipeline.run(spark, SF).count() > 100


def test_stages_keep_odd_rows_and_columns_of_clashing_names(spark):
    extra = ["score", "Items", "runs", "n_words", "secrets", "candidates", "_row", "_owner", "_own_score", "ids", "decoded", "n"]
    docs = table(spark, SF, "documents").limit(40)
    odd = docs.limit(1).select(*[F.lit(None).cast(t).alias(n) for n, t in docs.dtypes])
    named = docs.unionByName(docs.limit(2)).unionByName(odd.withColumn("doc_id", F.lit(-1).cast("long"))).unionByName(odd)
    named = named.select("*", *[F.concat(F.lit(f"{n} "), F.coalesce(F.col("doc_id"), F.lit(0))).alias(n) for n in extra])
    ids = Counter(r.doc_id for r in named.select("doc_id").collect())
    for name, stage in corpus_pipeline.STAGES:
        out = stage(spark, named, SF)
        rows, last = out.collect(), name == corpus_pipeline.STAGES[-1][0]
        found = Counter(r.doc_id for r in rows)
        assert all(found[i] in (0, n) for i, n in ids.items()) and set(found) <= set(ids), name
        if not last:
            assert out.columns == named.columns, name
            assert all(r[n] == f"{n} {r.doc_id or 0}" for r in rows for n in extra), name
        if "secret" in name or last:
            assert found == ids
        assert stage(spark, named.limit(0), SF).count() == 0
