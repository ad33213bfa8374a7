"""Jaccard join, shards, neighbours, toxicity, pages and preference pairs against plain versions."""

from collections import Counter, defaultdict

import numpy as np
import pandas as pd
import pytest

from tests.conftest import rows
from tests.llm.cases import documents, empty, prose
from pyspark.sql import functions as F

from wardspark.llm import jaccard, main_text, neighbours, preference, sharding, toxicity
from wardspark.llm.components import components


def near_family(seed, n, words=200):
    """Copies of one text, each with one word changed: some pairs are above the threshold, some below."""
    base = prose(seed, words).split()
    out = [" ".join(base)]
    for i in range(n - 1):
        copy = list(base)
        for j in range(1 + i % 4):
            copy[(i * 13 + j * 29) % words] = f"new{i}_{j}"
        out.append(" ".join(copy))
    return out


def brute(texts):
    sets = [set(jaccard.shingles(t or "").tolist()) for t in texts]
    links = defaultdict(set)
    for i in range(len(texts)):
        for j in range(i):
            same = texts[i] is not None and texts[i] == texts[j]
            if same or sets[i] and sets[j] and len(sets[i] & sets[j]) >= 0.8 * len(sets[i] | sets[j]) - 1e-9:
                links[i].add(j)
                links[j].add(i)
    return links


@pytest.mark.parametrize("cell", [512, 7])
def test_join_equals_brute_force(spark, monkeypatch, cell):
    monkeypatch.setattr(jaccard, "CELL", cell)
    texts = near_family(3, 24) + near_family(5, 9) + [prose(k, 60) for k in range(30, 60)] + [prose(31, 60)] * 3
    texts += ["a b c", "a b c", "", "", None, None, "  ", "five words are just enough"]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(4)
    got = {r.doc_id: r for r in jaccard.near_duplicates(docs).collect()}
    links = brute(texts)
    for i in range(len(texts)):
        seen, todo = {i}, [i]
        while todo:
            for j in links[todo.pop()] - seen:
                seen.add(j)
                todo.append(j)
        assert got[i].class_id == min(seen), i
        assert got[i].n_links == len(links[i]), i
    kept = jaccard.distinct_documents(docs)
    assert sorted(r.doc_id for r in kept.collect()) == sorted({r.class_id for r in got.values()})


@pytest.mark.parametrize("split", [False, True])
def test_block_compares_pairs_without_a_common_node(split):
    texts = near_family(3, 60) + near_family(5, 9) + [prose(k, 60) for k in range(30, 40)]
    names = [f"h{i:03}" for i in range(len(texts))]
    block = pd.DataFrame({"hash": names, "text": texts, "copies": 1, "side": [i % 2 for i in range(len(texts))], "split": split})
    links = {i: {j for j in held if not split or (i - j) % 2} for i, held in brute(texts).items()}
    for i, (name, n, other) in enumerate(jaccard._verify(block)):
        seen, todo = {i}, [i]
        while todo:
            for j in links.get(todo.pop(), set()) - seen:
                seen.add(j)
                todo.append(j)
        assert (name, n, other) == (names[i], len(links.get(i, ())), names[min(seen)])


def test_shared_counts_of_rare_and_common_shingles():
    rng = np.random.default_rng(2)
    sets = [np.unique(rng.integers(0, 3000 if i % 2 else 300, 200)).astype(np.uint64) for i in range(40)]
    every = np.arange(40)
    got = jaccard._shared(sets, every, every)
    assert got.tolist() == [[len(np.intersect1d(a, b)) if i != j else got[i, i] for j, b in enumerate(sets)] for i, a in enumerate(sets)]


def test_join_of_awkward_rows(spark):
    assert jaccard.near_duplicates(empty(spark)).count() == 0
    assert jaccard.distinct_documents(empty(spark)).count() == 0
    docs = documents(spark)
    got = jaccard.near_duplicates(docs).collect()
    assert len(got) == docs.count()
    by_id = {r.doc_id: r.class_id for r in got}
    assert by_id[1] == by_id[2] == by_id[3] == 1 and by_id[None] is None and by_id[6] == 6
    kept = jaccard.distinct_documents(docs)
    assert kept.columns == docs.columns
    assert Counter(r.doc_id for r in kept.collect()) == Counter([1, 4, 5, 6, 7, 8, None, 9, 10, 11, 12])


def test_depth_meets_the_target_recall():
    for recall in (jaccard.RECALL, jaccard.FULL):
        depth = jaccard.depth_for(recall=recall)
        assert 1 - (1 - 0.8**depth) ** jaccard.TREES >= recall > 1 - (1 - 0.8 ** (depth + 1)) ** jaccard.TREES
    assert jaccard.depth_for(recall=jaccard.FULL) < jaccard.depth_for() < jaccard.DEPTH


def plain_proposals(keys):
    """Groups of texts by the nodes of plain dictionaries, prefixes shortened for texts without a candidate."""
    deep, least = jaccard.depth_for(), jaccard.depth_for(recall=jaccard.FULL)
    group, matched = {v: {v} for v in keys}, set()
    for level in range(deep, least - 1, -1):
        nodes = defaultdict(set)
        for v, rows_ in keys.items():
            for row in rows_:
                nodes[row[:1 + 2 * level].tobytes()].add(v)
        joined = [n for n in nodes.values() if len(n) > 1 and (level == deep or n - matched)]
        for node in joined:
            whole = set().union(*[group[v] for v in node])
            for v in whole:
                group[v] = whole
        matched |= set().union(*joined)
    return {frozenset(g) for g in group.values() if len(g) > 1}


@pytest.mark.parametrize("batch", [10000, 3])
def test_forest_proposes_the_nodes_of_plain_tries(spark, batch):
    draw = np.random.default_rng(4)
    keys = {}
    for i in range(150):
        rows_ = np.empty((jaccard.TREES, jaccard._KEY), np.uint8)
        rows_[:, 0] = np.arange(jaccard.TREES)
        rows_[:, 1:] = draw.integers(0, 256, rows_[:, 1:].shape)
        for _ in range(int(draw.integers(0, 3)) if i else 0):  # some prefixes of earlier texts, of any length
            other, tree, level = int(draw.integers(max(0, i - 40), i)), int(draw.integers(jaccard.TREES)), int(draw.integers(3, 9))
            rows_[tree, :1 + 2 * level] = keys[f"{other:032x}"][tree, :1 + 2 * level]
        keys[f"{i:032x}"] = rows_
    for i in range(60):  # equal in all tries, over several batches and partitions
        keys[f"{1000 + i:032x}"] = keys[f"{7:032x}"]
    texts = spark.createDataFrame([(h, k.tobytes()) for h, k in keys.items()] + [("f" * 32, None)], "hash string, keys binary")
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(batch))
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        groups = defaultdict(set)
        for r in components(jaccard._proposals(texts)).collect():
            groups[r.root].add(r.vertex)
    finally:
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")
    assert {frozenset(g) for g in groups.values()} == plain_proposals(keys)


def test_keys_do_not_depend_on_the_order_or_chunks_of_shingles(monkeypatch):
    runs = jaccard.shingles(prose(9, 3000))
    whole = jaccard.Forest().keys(runs)
    monkeypatch.setattr(jaccard, "_CHUNK", 17)
    assert (jaccard.Forest().keys(runs[::-1]) == whole).all()
    # The share of equal hashes is near the similarity of the sets.
    other = jaccard.Forest().keys(runs[: len(runs) // 2])
    first = [(whole[t, k:k + 2] == other[t, k:k + 2]).all() for t in range(jaccard.TREES) for k in range(1, jaccard._KEY, 2)]
    assert 0.35 < np.mean(first) < 0.65


def test_components(spark):
    pairs = [(i, i + 1) for i in range(50)] + [(100, 100 + i) for i in range(1, 60)] + [(200, 201), (201, 200), (7, 7)]
    got = defaultdict(set)
    for v, root in rows(components(spark.createDataFrame(pairs, "a long, b long"))):
        got[root].add(v)
    assert sorted(map(sorted, got.values())) == [list(range(51)), list(range(100, 160)), [200, 201]]
    assert components(spark.createDataFrame([], "a long, b long")).count() == 0


@pytest.mark.parametrize("dims,bits", [(2, 3), (3, 2)])
def test_hilbert_neighbours_touch(dims, bits):
    cells = np.array(np.meshgrid(*[range(1 << bits)] * dims)).reshape(dims, -1).T
    index = sharding.hilbert_index(cells, bits)
    assert sorted(index.tolist()) == list(range(1 << (dims * bits)))
    path = cells[np.argsort(index)]
    assert (np.abs(np.diff(path, axis=0)).sum(axis=1) == 1).all()


def test_shards_are_equal_runs(spark):
    docs = documents(spark)
    got = sharding.assign(docs).collect()
    counts = Counter(r.shard for r in got)
    assert len(got) == docs.count() and max(counts.values()) - min(counts.values()) <= 1
    for shard in counts:
        assert sorted(r.slot for r in got if r.shard == shard) == list(range(counts[shard]))
    order = sorted(got, key=lambda r: (r.shard, r.slot))
    assert [r.curve for r in order] == sorted(r.curve for r in got)
    again = sharding.assign(docs.repartition(3)).collect()
    assert sorted(map(str, again)) == sorted(map(str, got))
    assert sharding.assign(empty(spark)).count() == 0
    one = {r.doc_id: r for r in got}
    assert one[6]["size"] == 1 and one[6].text_crc32 == 0 and one[10]["size"] == len(("é🙂 日本 " * 30).encode()) + 1


def test_shard_files_hold_all_rows(spark, tmp_path):
    docs = documents(spark)
    sharding.write_shards(docs, str(tmp_path / "shards"), 4)
    back = spark.read.parquet(str(tmp_path / "shards"))
    assert sorted(map(str, back.select(*docs.columns).collect())) == sorted(map(str, docs.collect()))
    assert back.select("_shard").distinct().count() == 4


def test_neighbours_recall_ties_and_unusable_vectors(spark):
    rng = np.random.default_rng(5)
    centres = rng.standard_normal((8, 16))
    x = (centres[rng.integers(0, 8, 900)] + 0.6 * rng.standard_normal((900, 16))).astype(np.float32)
    x[300:420] = x[40]
    data = [(i, v.tolist(), 1) for i, v in enumerate(x)]
    odd = [(1000, None), (1020, [0.0] * 16), (1040, [float("nan")] + [1.0] * 15), (1060, [None] + [1.0] * 15), (1080, [1.0, 2.0]), (None, [1.0] * 16)]
    table = spark.createDataFrame(data + [(i, v, 0) for i, v in odd], "vec_id long, embedding array<float>, score int")
    got = defaultdict(list)
    for r in neighbours.nearest(table).orderBy("query_id", "rank").collect():
        got[r.query_id].append((r.vec_id, r.score))
    assert sorted(got) == list(range(0, 900, 20))
    exact = x.astype(float)
    hits = 0
    for q, found in got.items():
        scores = (exact * exact[q]).sum(axis=1)
        best = [i for i in np.lexsort((np.arange(900), -scores)).tolist() if i != q][:20]
        assert len(found) == 20 and all(abs(scores[i] - s) < 1e-9 for i, s in found)
        hits += len(set(best) & {i for i, _ in found})
        if q == 40:
            assert [i for i, _ in found] == best
    assert hits >= 0.95 * 20 * len(got)
    assert neighbours.nearest(table.limit(0)).count() == 0
    few = neighbours.nearest(table.where("vec_id < 4"))
    assert rows(few.select("query_id", "rank")) == [(0, 1), (0, 2), (0, 3)]


def test_toxicity_on_held_out_rows(spark):
    bad = ("worthless", "scum", "idiot")
    texts = [(i, prose(i + 2, 40) + (f" {bad[i % 3]} you" if i % 6 == 0 else "")) for i in range(900)]
    docs = spark.createDataFrame([*texts, (5000, None), (5001, "")], "doc_id long, text string")
    labels = spark.createDataFrame([(i, 1, int(i % 6 == 0)) for i in range(900) if i % 4 < 2] + [(5000, None, None)], "doc_id long, quality int, toxic int")
    model = toxicity.fit(docs, labels)
    got = {r.doc_id: r for r in toxicity.score(docs, model).collect()}
    held = [i for i in range(900) if got[i].held_out]
    assert len(held) > 100 and sum(got[i].predicted == int(i % 6 == 0) for i in held) >= 0.97 * len(held)
    assert got[5000].score == got[5001].score and got[5000].predicted == 0
    none = toxicity.fit(docs, labels.where("toxic = 0"))
    assert toxicity.score(empty(spark), none).count() == 0 and none.weights == {}


def test_non_negative_risk_resists_overfitting():
    toxic = [f"bad common{i % 5}" for i in range(60)]
    mixed = [f"bad common{i % 5}" for i in range(30)] + [f"fine common{i % 5}" for i in range(270)]
    model = toxicity.train(toxic, mixed, 0.1)
    assert model.score("bad common1") > 0.5 > model.score("fine common1")


PAGE = """<!DOCTYPE html><html><head><title>T</title><script>var a="</p><article>";</script></head><body><header><h2>Site name</h2></header>
<nav><ul><li><a href=x>one</a></li></ul></nav><div class="cookie-notice">We use cookies here</div>
<article><h1>Head &amp; line</h1><p>First <b>bold</b> para&#233;<br>next<p>Second one has a few more words here</p><div class="ad">Buy now</div>
<ul><li>item a</li><li>item b</li></ul><form><input><label>Your mail</label></form></article>
<div id="comments"><p>a reader says quite a lot of words here</p></div><footer>end words</footer></body></html>"""


def test_main_text_of_pages(spark):
    schema = "page_id long, url string, html string, text string, n_chars int"
    simple = "<html><body><nav><a>x</a></nav><article><h1>t{0}</h1><p>word one two three {0}</p></article><footer>f</footer></body></html>"
    pages = [(i, f"u{i}", simple.format(i), "q", 0) for i in range(8)]
    odd = [(20, "a", PAGE, "", 1), (21, None, None, "", 1), (22, "b", "", "", 1), (23, "c", "<p>cut off &am", "", 1), (23, "c", "<p>cut off &am", "", 1),
           (24, "d", "<nav>only menu</nav>", "", 1), (25, "e", "<p>" + "many words " * 20000, "", 1)]
    got = sorted((r.page_id, r.text, r.n_chars) for r in main_text.main_texts(spark.createDataFrame(pages + odd, schema)).collect())
    assert got[:8] == [(i, f"t{i}\nword one two three {i}", len(f"t{i}\nword one two three {i}")) for i in range(8)]
    texts = {i: t for i, t, _ in got}
    assert texts[20] == "Head & line\nFirst bold paraé next\nSecond one has a few more words here\nitem a\nitem b"
    assert texts[21] == texts[22] == texts[24] == "" and texts[23] == "cut off &am" and len(texts[25].split()) == 40000
    assert len(got) == 15 and main_text.main_texts(spark.createDataFrame([], schema)).count() == 0


BODY = "<h1>Title line</h1><p>{0}</p><p>{0}</p>".format("plain words of the text that run on " * 8)


@pytest.mark.parametrize("name", ["site-content has-sidebar", "layout no-sidebar", "container header-fixed", "legal", "alert"])
@pytest.mark.parametrize("body", [BODY, f"<article>{BODY}</article>"])
def test_wrappers_that_sound_like_boilerplate(name, body):
    weights = main_text.Weights({}, {})
    side = '<div class="sidebar"><p>side words</p></div><div id="comments"><p>a reader says words</p></div>'
    plain = main_text.extract(f"<body><div>{body}</div></body>", weights)
    assert plain.startswith("Title line") and len(plain.split()) == 2 + 2 * 8 * 8
    assert main_text.extract(f'<body><div class="{name}">{body}{side}</div></body>', weights) == plain
    assert main_text.extract(f'<body><form id="aspnet">{body}{side}</form></body>', weights) == plain


def test_widgets_headings_and_notes_stay_and_adverts_go():
    weights = main_text.Weights({}, {})
    widget = '<div class="elementor-widget elementor-widget-{}">{}</div>'
    parts = [("heading", "<h1>Title of more than a few words</h1>"), *[("text", f"<p>part {i} {'has words ' * 10}</p>") for i in range(5)]]
    got = main_text.extract("<body>" + "".join(widget.format(*p) for p in parts) + "</body>", weights).split("\n")
    assert [x.split()[:2] for x in got] == [["Title", "of"]] + [["part", str(i)] for i in range(5)]
    inside = '<div class="entry-header"><h1>Title of five plain words</h1></div><p>' + "words here " * 9 + '</p><div class="alert">Note this</div><div class="ad">Buy now</div>'
    for page in (f"<article>{inside}</article>", f'<div class="post"><div class="x-entry-header"><h1>Title of five plain words</h1></div><p>{"words here " * 9}</p></div>'):
        got = main_text.extract(f"<body>{page}<div id='comments'><p>{'talk ' * 90}</p></div></body>" if "article" in page else page, weights)
        assert got.startswith("Title of five plain words\nwords here") and "Buy" not in got and "talk" not in got and ("Note this" in got) == ("alert" in page)


def test_best_run():
    assert main_text.best_run([-1, 2, -1, 3, -5, 4]) == (1, 3)
    assert main_text.best_run([-1, -2]) == (0, -1) and main_text.best_run([]) == (0, -1)


def test_preference_pairs(spark):
    turn = "array<struct<role:string,text:string>>"
    u, a, b = ("user", "hi"), ("assistant", "é🙂"), ("assistant", "no")
    pairs = spark.createDataFrame(
        [(1, [u, a, u, b], [u, a, u, a]), (2, [u, a], [u, a]), (3, None, [u]), (4, [], []), (5, [u, a, u], [u, a])],
        f"pair_id int, chosen {turn}, rejected {turn}")
    got = {r.pair_id: r for r in preference.format_pairs(pairs).collect()}
    assert got[1].prompt_turns == 3 and got[1].prompt == "<|user|>\nhi<|end|>\n<|assistant|>\né🙂<|end|>\n<|user|>\nhi<|end|>\n"
    begin, end = map(int, got[1].chosen_mask.split(":"))
    assert got[1].chosen[begin:end] == "no<|end|>" and got[1].rejected == "<|assistant|>\né🙂<|end|>\n"
    assert not got[2].differs and got[2].chosen == "" and got[2].chosen_mask == ""
    assert got[3].prompt == "" and got[3].rejected_mask == "" and got[3].differs and not got[4].differs
    assert got[5].prompt_turns == 2 and got[5].chosen == "<|user|>\nhi<|end|>\n" and got[5].chosen_mask == ""


def test_pairs_hold_every_turn_and_the_next_answer_there_is(spark):
    turns = [(1, 0, "user", "q"), (1, 1, "assistant", "a"), (1, 2, "user", "more"), (1, 3, "system", None), (3, 0, "user", None),
             (7, 0, "user", "q"), (7, 1, "assistant", "b"), (90, 0, None, "x"), (90, 1, "assistant", "c"), (None, 0, "user", "lost")]
    table = spark.createDataFrame(turns, "conv_id long, turn long, role string, text string").withColumns({"answer": F.lit(1), "place": F.lit("x")})
    got = {r.pair_id: r for r in preference.against_next_answer(table.unionAll(table.where("false"))).collect()}
    assert sorted(got) == [1, 3, 7, 90]
    assert [got[i].rejected for i in (1, 3, 7, 90)] == ["<|assistant|>\nb<|end|>\n", "", "<|assistant|>\nc<|end|>\n", ""]
    assert [got[i].after_turns for i in (1, 3, 7, 90)] == [2, 0, 0, 0]
    for i, r in got.items():
        whole = "".join(f"<|{role or 'user'}|>\n{text or ''}<|end|>\n" for c, _, role, text in turns if c == i)
        assert r.prompt + r.chosen + r.after == whole
    assert preference.against_next_answer(table.limit(0)).count() == 0
    twice = {r.pair_id: r for r in preference.against_next_answer(table.unionAll(table)).collect()}
    assert twice[7].prompt == "<|user|>\nq<|end|>\n" * 2 + "<|assistant|>\nb<|end|>\n"  # repeated turns stay


def test_best_run_is_the_best_of_all_runs():
    draw = np.random.default_rng(8)
    for n in (1, 5, 30):
        for _ in range(40):
            scores = draw.integers(-5, 6, n).astype(float).tolist()
            first, last = main_text.best_run(scores)
            sums = {(i, j): sum(scores[i:j + 1]) for i in range(n) for j in range(i, n)}
            most = max(sums.values())
            assert (first, last) == (0, -1) if most <= 0 else sums[first, last] == most


@pytest.mark.parametrize("tag,expected", [
    ('<p title="5" tall">', "kept words here"), ("<p title='5' tall'>", "kept words here"), ('<p class=a"b>', "kept words here"),
    ('<p data-x="a > b">', "kept words here"), ("<p title='open>", "kept words here"),
])
def test_markup_never_becomes_text(tag, expected):
    page = f"<body><article>{tag}kept words here</p></article><script>if (a<b && c==\"x\") d=1;</script></body>"
    assert main_text.extract(page, main_text.Weights({}, {})) == expected


def test_long_pages_take_time_in_proportion():
    import time

    weights = main_text.Weights({}, {})
    many = 100_000
    for page in ("<div>" * many + "end", "<div class='sidebar'>" * many + "end", '<div title="5" tall">w ' * many, "<p>a</b>" * many,
                 "<" * many, "<a b='" * many, "<!--" * many):
        start = time.perf_counter()
        main_text.extract(page, weights)
        assert time.perf_counter() - start < 20


def clustered(n, width=32, spread=0.5):
    rng = np.random.default_rng(11)
    centres = rng.standard_normal((12, width))
    return centres[rng.integers(0, 12, n)] + spread * rng.standard_normal((n, width))


def test_search_stops_early_and_finds_the_neighbours(spark, monkeypatch):
    x = clustered(6000)
    projection = neighbours.Projection(32, float((x * x).sum(axis=1).max()))
    index = neighbours.Index(np.arange(6000), x, projection)
    hits, asked = 0, range(0, 6000, 100)
    for q in asked:
        scores = x @ x[q]
        scores[q] = -np.inf
        hits += len(set(np.argsort(-scores)[:20].tolist()) & set(index.search(q, x[q], 20)[0].tolist()))
    assert hits >= 0.9 * 20 * len(asked)
    assert index.verified < 0.6 * 6000 * len(asked)  # the stop fires


def test_batches_come_in_projected_order_and_hold_every_row():
    x = clustered(3000)
    projection = neighbours.Projection(32, float((x * x).sum(axis=1).max()))
    index = neighbours.Index(np.arange(3000), x, projection)
    point = projection.queries(x[7:8])[0]
    away = ((index.points - point) ** 2).sum(axis=1)
    batches = list(index.neighbours(point))
    order = np.concatenate([rows for _, rows in batches])
    assert sorted(order.tolist()) == list(range(3000)) and (np.diff(away[order]) >= -1e-9).all()
    assert all(abs(away[rows].min() - first) < 1e-9 for first, rows in batches)


@pytest.mark.parametrize("block,query_block", [(200, 16), (1500, 1000)])
def test_neighbours_over_several_cells(spark, monkeypatch, block, query_block):
    monkeypatch.setattr(neighbours, "BLOCK", block)
    monkeypatch.setattr(neighbours, "QUERY_BLOCK", query_block)
    monkeypatch.setattr(neighbours, "LEAF", 16)
    x = clustered(2400, 16)
    x[500:1300] = x[500] + 1e-3 * np.random.default_rng(3).standard_normal((800, 16))  # a third of the rows in one cell
    table = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(x)], "vec_id long, embedding array<double>")
    got = defaultdict(list)
    for r in neighbours.nearest(table).collect():
        got[r.query_id].append((r.rank, r.vec_id, r.score))
    assert sorted(got) == list(range(0, 2400, 20))
    hits = 0
    for q, found in got.items():
        scores = (x * x[q]).sum(axis=1)
        best = [i for i in np.lexsort((np.arange(2400), -scores)).tolist() if i != q][:20]
        assert [r for r, _, _ in sorted(found)] == list(range(1, 21)) and len({i for _, i, _ in found}) == 20
        assert all(abs(scores[i] - s) < 1e-9 for _, i, s in found)
        hits += len(set(best) & {i for _, i, _ in found})
    assert hits >= 0.9 * 20 * len(got)


def test_chi_square_quantiles():
    for p, m, value in ((0.95, 8, 15.507), (0.9, 16, 23.542), (0.5, 4, 3.357)):
        assert abs(neighbours.chi_square_quantile(p, m) - value) < 0.02 * value


@pytest.mark.parametrize("shift", [3.0, -3.0])
def test_slopes_are_the_numeric_gradient_of_the_stated_risk(shift):
    draw = np.random.default_rng(4)
    n, prior = 7, 0.3
    logits = draw.standard_normal(30) + np.where(np.arange(30) < n, shift, -1.0)

    def risk(z):
        softplus = lambda x: np.log(1 + np.exp(x))
        toxic = prior * softplus(-z[:n]).mean()
        clean = softplus(z[n:]).mean() - prior * softplus(z[:n]).mean()
        return toxic + clean if clean >= 0 else -clean

    assert (toxicity.clean_risk(logits, n, prior) < 0) == (shift > 0)  # both branches are met
    numeric = [(risk(logits + e) - risk(logits - e)) / 2e-6 for e in np.eye(30) * 1e-6]
    assert np.allclose(toxicity.slopes(logits, n, prior), numeric, atol=1e-7)


def test_toxicity_of_awkward_labels(spark):
    docs = documents(spark)
    labels = spark.createDataFrame([(None, None, 1, "z"), (1, 1, None, "z"), (2, 1, 0, "z")], "doc_id long, quality int, toxic int, text string")
    for marked in (labels, labels.limit(0), labels.where("toxic is null")):
        model = toxicity.fit(docs, marked)
        got = toxicity.score(docs, model).collect()
        assert len(got) == docs.count() and all(0 <= r.score < 0.5 and r.predicted == 0 for r in got)
    long = spark.createDataFrame([(1, "word " * 300_000), (2, "word")], "doc_id long, text string")
    a, b = toxicity.score(long, toxicity.Model({"word": 2.0}, -1.0)).collect()
    assert a.score == b.score > 0.5


def test_shards_equal_a_plain_assignment(spark):
    docs = documents(spark)
    got = {(r.doc_id, r["size"], r.text_crc32): r for r in sharding.assign(docs).collect()}
    import math
    import zlib

    values = docs.collect()
    cells = {}
    for column in ("source", "lang"):
        names = sorted({r[column] for r in values}, key=lambda v: (v is not None, v or ""))
        cells[column] = {v: k * 32 // max(len(names), 32) for k, v in enumerate(names)}
    plain = []
    for r in values:
        data = (r.text or "").encode()
        size = len(data) + 1
        cell = [cells["source"][r.source], cells["lang"][r.lang], min(math.floor(2 * math.log2(size)), 31)]
        curve = int(sharding.hilbert_index(np.array([cell]), 5)[0])
        plain.append((curve, -1 if r.doc_id is None else r.doc_id, size, zlib.crc32(data), r.doc_id))
    plain.sort(key=lambda x: x[:4])
    n = len(plain)
    for place, (curve, _, size, crc, doc_id) in enumerate(plain):
        shard = place * 8 // n
        row = got[doc_id, size, crc]
        assert row.curve == curve and row.shard == shard
        if doc_id != 4:  # doc 4 is there twice, alike in all columns
            assert row.slot == sum(p * 8 // n == shard for p in range(place))
