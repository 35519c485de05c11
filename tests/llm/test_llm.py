"""The training-data operators against brute force, round trips and held-out accuracy, and their edge cases."""

import html
import math
import random
import re
from collections import Counter, defaultdict

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from tidemark.llm import batches, encoding, leaks, markup, names, packing, pii, places, residue, simhash
from tidemark.llm.boost import Boost, best_threshold
from tidemark.llm.components import components
from tidemark.llm.tree import Tree


def rows(df, *cols):
    return sorted(tuple(r) for r in (df.select(*cols) if cols else df).collect())


# ------------------------------------------------------------- p2 names


@pytest.mark.parametrize(
    ("a", "b", "same"),
    [
        ("Fiwougom Capital", "FIWOUGOM_CAPITAL", True), ("Gotropres Faskut Health Inc.", "Gotropres Fasut Health", True), ("Foods, Beagrakai Jaboum", "The Beagrakai Jaboum Foods Group", True), ("GealouvamRodrairNetworks", "Gealouvam Rodrair Networks GmbH", True),
        ("Hovem Fuzidour Networks", "Fuzidour Hovem Nets", True), ("Bob Juropre Consulting", "Robert Juropre Consulting", True), ("Grehiza, Gabriela & Partners", "Gabriela Grehiza and Partners", True), ("Hudekeax Zonin Agri-Tech Co.", "Hudekeax Zonin Agritech", True),
        ("Keagronait Health", "Keagronait Buhil Capital", False), ("Gealouvam Korarn Health", "Gealouvam Rodrair Networks", False), ("Keagronait Health", "Keagronait Foods", False), ("Keagronait", "Keagronait Health", False),
    ],
)
def test_compare_full(a, b, same):
    got = names.compare(names.parse(a), names.parse(b))
    assert (got is not None and got[0] == "full") == same


def test_link_names(spark):
    given = ["z" * 4000 + " Media", "z" * 3999 + "y Media", "Robert Jeropre Consulting", "Bob Jeropre Consulting", "R. Jeropre Consulting", "Jeropre Consulting", "Robert Jeropre", "Rita Jeropre Studio", "S. Fenani Studio", "Samuel Fenani Studio", "Susanna Fenani Studio", "", " ", None, None, "!!!"]
    df = spark.createDataFrame([(x, "k") for x in given], "company string, key string")
    linked = names.link_names(df)
    groups = defaultdict(set)
    for c, e in rows(linked, "company", "entity"):
        groups[e].add(c)
    of = {c: g for g in groups.values() for c in g}
    assert of["Bob Jeropre Consulting"] == {"Robert Jeropre Consulting", "Bob Jeropre Consulting", "R. Jeropre Consulting", "Jeropre Consulting", "Robert Jeropre"}
    assert of["S. Fenani Studio"] == {"S. Fenani Studio"}  # two could be meant
    assert of["Rita Jeropre Studio"] == {"Rita Jeropre Studio"} and len(of) == 14 and len(of["z" * 4000 + " Media"]) == 2
    pairs = rows(names.name_pairs(linked))
    assert len(pairs) == 11 and all(a < b for a, b in pairs)
    assert names.link_names(df.limit(0)).count() == 0


@settings(max_examples=200, deadline=None)
@given(st.text("abcd", max_size=7), st.text("abcd", max_size=7))
def test_edit_distance(a, b):
    def brute(i, j, memo={}):  # noqa: B006
        if (k := (a, b, i, j)) not in memo:
            if not i or not j:
                memo[k] = i + j
            else:
                memo[k] = min(brute(i - 1, j) + 1, brute(i, j - 1) + 1, brute(i - 1, j - 1) + (a[i - 1] != b[j - 1]))
                if i > 1 and j > 1 and a[i - 1] == b[j - 2] and a[i - 2] == b[j - 1]:
                    memo[k] = min(memo[k], brute(i - 2, j - 2) + 1)
        return memo[k]

    d = brute(len(a), len(b))
    assert names.edits(a, b, 3) == min(d, 4)
    if d <= 1:
        assert names.one_deleted(a, False) & names.one_deleted(b, False)


def test_components(spark):
    edges = [(str(i), str(i + 1)) for i in range(40)] + [("x", f"y{i}") for i in range(50)] + [("z", "z"), (None, "q")]
    got = dict(rows(components(spark.createDataFrame(edges, "a string, b string"))))
    assert len({got[str(i)] for i in range(41)}) == 1 and len({got["x"], *(got[f"y{i}"] for i in range(50))}) == 1 and got["z"] == "z" and "q" not in got
    assert components(spark.createDataFrame([], "a string, b string")).count() == 0


# ------------------------------------------------------------- p3 markup


@pytest.mark.parametrize(
    ("text", "want"),
    [
        ("<h2>A b</h2><p>c <a href='http://x'>d</a></p><ul><li>e<li>f</ul><p>• g<br>• h</p><pre>i &lt; j</pre><p>\\(k^2\\)</p><script>no()</script><!-- no -->", (1, 4, 1, 1, "Abcdefghijk2")),
        (html.escape("<h1>A</h1><p>b&nbsp;c</p>"), (1, 0, 0, 0, "Abc")),
        ("# A\n\nB\n---\n\n1. c\n* d [e](http://x)\n\n```python\nf = 1\n```\n\n$g^2$ costs $5 to $6\n\n| h | i |\n|---|---|\n| j | k |", (2, 2, 1, 1, "ABcdef1g2costs5to6hijk")),
        ("== A ==\n* b '''c'''\n[[Page:X|d]] [http://x e]\n<syntaxhighlight lang=\"js\">\nf()\n</syntaxhighlight>\n<math>g</math>\n{| class=\"w\"\n|-\n| h || i\n|}", (1, 1, 1, 1, "Abcdefghi")),
        ("\\section*{A}\n\\begin{itemize}\n  \\item b \\textbf{c} % no\n\\item \\href{http://x}{d}\n\\end{itemize}\n\\begin{verbatim}\ne\n\\end{verbatim}\n\\begin{equation}\n\\frac{f}{2}\n\\end{equation}\n5 \\% \\begin{tabular}{ll}g & h \\\\ i\n\\end{tabular}", (1, 2, 1, 1, "Abcdefracf25ghi")),
    ],
)
def test_markup(text, want):
    _, clean, h, i, c, f, *_ = markup.summary(text)
    assert (h, i, c, f, markup.NOT_LETTERS.sub("", clean)) == want


@pytest.mark.parametrize("text", ["plain text", "• a\n• b", "YOUR PROFILE\n\nWe are #1 of 5 * 3", "costs $5 to $6", "a < b and c > d", "Gross pay: {{x}} per month.", ""])
def test_no_markup(text):
    assert markup.summary(text) is None


@settings(max_examples=150, deadline=None)
@given(st.text("<>/pabliul#*`$|=\\[](){}&; \n-_'\"%", max_size=80))
def test_markup_never_fails(text):
    markup.summary(text)


def test_convert_edges(spark):
    df = spark.createDataFrame([(1, "<p>x</p>", "t"), (1, "<p>x</p>", "t"), (2, None, "t"), (3, "", "t"), (4, "<h1>" + "word " * 50_000 + "</h1>", "t")], "row_id bigint, description_html string, markup string")
    got = rows(markup.convert(df), "row_id", "n_headings")
    assert got == [(1, 0), (1, 0), (4, 1)] and markup.convert(df.limit(0)).count() == 0


def test_roles_of_unmarked_lines():
    long = "We write good software for farmers and their many animals every single day."
    link = "<p><a href='http://x'>{}</a></p>"
    text = "".join(link.format(w) for w in ("Home", "Jobs", "About us")) + f"<p>{long}</p><p>Your tasks</p><p>{long}</p><p>See <a href='http://x'>our page</a>.</p><ul><li><a href='#'>One</a></li><li><a href='#'>Two</a></li><li>{long}</li></ul>"
    roles = [r for r, _ in markup.parse(text)[1]]
    assert roles == ["nav", "nav", "nav", "text", "label", "text", "text", "nav_item", "nav_item", "item"]
    assert markup.summary(text)[3] == 3 and markup.summary(text)[6:] == (1, 5)


def test_tree_learns_its_table():
    t = markup.role_tree()
    assert all(t.label(markup.features(*b[:-1])) == b[-1] for b in markup.BLOCKS)
    used, nodes = set(), [t.root]
    while nodes:
        node = nodes.pop()
        if not isinstance(node, str):
            used.add(markup.FEATURES[node[0]])
            nodes += node[2:]
    print(t.root)
    assert {"words", "density", "words_before", "words_after", "density_before"} <= used or {"words", "density", "words_before", "words_after", "density_after"} <= used
    assert Tree().fit([[0], [1], [2], [3]], ["a", "a", "b", "b"]).label([2.7]) == "b"


# ------------------------------------------------------------- p4 places


PLACES = "place_id int, city string, admin_area string, country_code string, country_name string, alt_name string"


@pytest.fixture(scope="module")
def gazetteer(spark):
    return spark.createDataFrame([(1, "São Bumenól", "Trust", "BR", "Brazil", None), (2, "Hevehold", "Prah", "FR", "France", None), (3, "Hevehold", "Maw", "DE", "Germany", None), (4, "Fort Kaskol", "X", "IE", "Ireland", "Old Kask"), (5, "Brasilt", "Y", "NL", "Netherlands", None), (6, "Gravat", "Z", "PL", "Poland", None), (7, None, "q", "PL", "Poland", None), (8, "São Teles", "Trust", "BR", "Brazil", None), (9, "Grüzüwölingen", "Gravit", "DE", "Germany", None)], PLACES)


@pytest.mark.parametrize(
    ("location", "country", "want"),
    [
        ("Sao Bumenol", None, {1}), ("S. Bumenól - BR", None, {1}), ("Hevehold", "Frankreich", {2}), ("Hevehold", None, {2, 3}), ("Hevehold, Maw, Germnay", None, {3}), ("Hevehold", "PL", {0}), ("Ft. Kaskl, Éire", "ie", {4}), ("Brasilt", "NL", {5}), ("Brasit, NLD", None, {5}),
        ("Greater Gravat Area / Remote or Hevehold", "POL", {6}), ("Gruezuewoelingen", None, {9}), ("Hevehold, Gravit", "FR", {2}), ("Sãão Bumenól", "br", {1}), ("So Bumenol", None, {1}), ("Gravat; Old Kask", None, {4, 6}), ("Poland", "PL", {0}), ("Remote", None, {0}), ("", None, {0}), ("-", "N/A", {0}), ("GRAAVAT (on-site)", "Rep. of Ireland", {0}), ("Gravatland", None, {0}), ("x" * 3000, None, {0}),
    ],
)
def test_link_places(spark, gazetteer, location, country, want):
    df = spark.createDataFrame([(1, location, country, 9), (2, None, "KE", 9)], "row_id bigint, location string, country string, place_id int")
    got = rows(places.link_places(df, gazetteer))
    assert {p for i, p in got if i == 1} == want and not [i for i, _ in got if i == 2]


def test_places_edges(spark, gazetteer):
    df = spark.createDataFrame([(1, "Gravat", None)] * 2, "row_id bigint, location string, country string")
    assert rows(places.link_places(df, gazetteer)) == [(1, 6)]
    assert rows(places.link_places(df, gazetteer.limit(0))) == [(1, 0)]
    assert places.link_places(df.limit(0), gazetteer).count() == 0


def test_places_plans_join_once(spark, gazetteer):
    """Every join takes memory of the driver: none may be planned twice."""
    n_joins = lambda df: df._jdf.queryExecution().optimizedPlan().toString().count("Join ")
    words, vocabulary = spark.createDataFrame([("nairobi",), ("nairobbi",), ("abcd",)], "word string"), spark.createDataFrame([("nairobi",), ("abc",)], "entry string")
    assert n_joins(places.repair(words, vocabulary)) == 1 and rows(places.repair(words, vocabulary), "word", "entry", "d") == [("nairobbi", "nairobi", 1), ("nairobi", "nairobi", 0)]
    assert n_joins(places.link_places(spark.createDataFrame([(1, "Nairobi", None)], "row_id bigint, location string, country string"), gazetteer)) <= 5


def test_repair_like_brute_force(spark):
    rng = random.Random(1)
    vocab = sorted({"".join(rng.choice("abcdefg") for _ in range(rng.choice((3, 5, 9, 11)))) for _ in range(60)})

    def typo(w):
        i = rng.randrange(len(w))
        return rng.choice((w[:i] + w[i + 1 :], w[:i] + "z" + w[i:], w[:i] + "y" + w[i + 1 :], w[:i] + w[i + 1 : i + 2] + w[i : i + 1] + w[i + 2 :]))

    words = sorted({typo(v) for v in vocab} | {typo(typo(v)) for v in vocab} | set(vocab[:9]))
    got = defaultdict(set)
    for w, e, d in rows(places.repair(spark.createDataFrame([(w,) for w in words], "word string"), spark.createDataFrame([(v,) for v in vocab], "entry string")), "word", "entry", "d"):
        got[w].add((e, d))

    def plain(a, b):
        row = list(range(len(b) + 1))
        for i, x in enumerate(a, 1):
            last, row = row, [i]
            for j, y in enumerate(b, 1):
                row.append(min(last[j] + 1, row[-1] + 1, last[j - 1] + (x != y)))
        return 1 if row[-1] == 2 and sorted(a) == sorted(b) else row[-1]

    for w in words:
        near = {(v, plain(w, v)) for v in vocab}
        ok = {(v, d) for v, d in near if d == 0 or (d == 1 and min(len(w), len(v)) >= 4) or (d == 2 and min(len(w), len(v)) >= 8)}
        best = {x for x in ok if x[1] == min(d for _, d in ok)} if ok else set()
        assert best == got[w]


# ------------------------------------------------------------- p5 batches


@pytest.mark.parametrize(
    ("a", "b"),
    [("4016679623", "https://x.example/view/4016679623?utm_source=feed"), ("4,020,995,478", "#4020995478"), ("004036318743", "jid=4036318743"), ("SA-0001007922", "sa_1007922"), ("a1b2c3d4-a0b0-c0d0-e0f0-0123456789ab", "urn:uuid:A1B2C3D4A0B0C0D0E0F00123456789AB"), ("thread-2024-05/12", "Thread 2024-05/12"), ("/jobs/dev-1a2b/", "DEV_1a2b#apply"), ("4013 028964", " 4013028964 ")],
)
def test_canonical_id(spark, a, b):
    df = spark.createDataFrame([(a, b)], "a string, b string")
    r = df.select(F.regexp_replace(batches.canonical_id(F.col("a")), "-", "").alias("a"), F.regexp_replace(batches.canonical_id(F.col("b")), "-", "").alias("b")).first()
    assert r.a == r.b and r.a


def test_repeated_postings_and_incremental_index(spark, tmp_path):
    jobs = spark.createDataFrame([(1, 1, "s", "A-01"), (2, 1, "s", "a_1"), (3, 2, "t", "A-1"), (4, 2, "old_s", "a1"), (5, 3, "s", None), (6, 3, None, "A-1"), (7, None, "s", "x://h/v/A-1"), (7, None, "s", "x://h/v/A-1"), (8, 3, "s", "--"), (9, 3, "s", "B2"), (10, 3, "s", "B-2")], "row_id bigint, batch_no int, source string, native_id string").withColumn("key", F.lit("clash"))
    config = spark.createDataFrame([("s", "s"), ("old_s", "s"), ("t", "t")], "source string, board string")
    got = rows(batches.repeated_postings(jobs, config, str(tmp_path / "i")))
    assert got == [(1, 2), (1, 4), (1, 7), (1, 7), (9, 10)]
    assert batches.repeated_postings(jobs.limit(0), config, str(tmp_path / "e")).count() == 0


@pytest.mark.parametrize("threshold", [1.0, 0.8])
def test_equal_keys_meet_across_batches_however_they_are_cut(spark, tmp_path, threshold):
    ids = ["KX-12-AB34", "kx12ab34", "KX12-ab34", "kx-12-ab35"]
    jobs = spark.createDataFrame([(i, i, "s", x) for i, x in enumerate(ids)], "row_id bigint, batch_no int, source string, native_id string")
    config = spark.createDataFrame([], "source string, board string")
    got = rows(batches.repeated_postings(jobs, config, str(tmp_path), threshold=threshold))
    assert got == [(0, 1), (0, 2)]


def test_near_duplicates_like_brute_force(spark, tmp_path):
    rng = random.Random(3)
    sets = [frozenset(rng.sample("abcdefghij", rng.choice((4, 5, 6)))) for _ in range(60)]
    df = spark.createDataFrame([(i, f"k{i}", sorted(s)) for i, s in enumerate(sets)], "row_id bigint, key string, tokens array<string>")
    index = batches.BatchIndex(spark, str(tmp_path / "n"), threshold=0.8)
    for b in (0, 1, 0, 2, 1):  # batches that come again change nothing
        index.add_batch(df.where(F.col("row_id").between(20 * b, 20 * b + 19)), b)
    got = {r.key: r.first_row_id for r in index.verdicts().collect()}
    like = lambda a, b: len(a & b) / len(a | b) >= 0.8
    assert len(got) == 60
    for i, s in enumerate(sets):
        assert got[f"k{i}"] == min(j for j in range(i + 1) if like(s, sets[j]))


BATCHES = [[(1, "a"), (2, "b"), (3, "a")], [(4, "b"), (5, "c")], [(6, "a"), (7, "c"), (8, "d")], [(9, "d"), (10, "e")], [(11, "e"), (12, "a")]]


def add(spark, index, *numbers):
    for n in numbers:
        index.add_batch(spark.createDataFrame([(i, k, [k]) for i, k in BATCHES[n]], "row_id bigint, key string, tokens array<string>"), n)


def first_rows(index):
    return {(r.batch, r.key): r.first_row_id for r in index.verdicts().collect()}


def expected(numbers):
    return {(n, k): min(i for m in range(n + 1) for i, x in BATCHES[m] if x == k) for n in numbers for _, k in BATCHES[n]}


def test_a_batch_added_again_replaces_itself(spark, tmp_path):
    index = batches.BatchIndex(spark, str(tmp_path))
    add(spark, index, 0, 0, 1, 0, 2, 1)
    assert first_rows(index) == expected(range(3)) and index.batches == [0, 1, 2]
    assert {k for (b, k) in first_rows(index)} == set("abcd")


def test_an_index_goes_on_when_it_is_opened_again(spark, tmp_path):
    add(spark, batches.BatchIndex(spark, str(tmp_path)), 0, 1)
    for t in spark.catalog.listTables():
        if t.name.startswith("tidemark_"):
            spark.sql(f"DROP TABLE {t.name}")  # as in a new session
    (tmp_path / "postings-0" / "run=77").mkdir()  # what a failed attempt left
    again = batches.BatchIndex(spark, str(tmp_path))
    assert again.batches == [0, 1]
    add(spark, again, 2, 3)
    assert first_rows(again) == expected(range(4))
    with pytest.raises(ValueError):
        batches.BatchIndex(spark, str(tmp_path), threshold=0.8)


def test_runs_are_merged_and_buckets_grow(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(batches, "FAN", 2)
    index = batches.BatchIndex(spark, str(tmp_path), bucket_bytes=1500)
    start = index.state["buckets"]
    add(spark, index, 0, 1, 2)
    add(spark, index, 1, 3, 4)  # batch 1 lies in a merged run by then
    assert first_rows(index) == expected(range(5))
    assert index.state["buckets"] > start and len(index.state["runs"]) <= 3
    assert len([n for n in index.files.names() if n.startswith("postings-")]) == 1
    again = batches.BatchIndex(spark, str(tmp_path))
    add(spark, again, 4)
    assert first_rows(again) == expected(range(5))


def test_a_small_batch_opens_only_its_buckets(spark, tmp_path, monkeypatch):
    index = batches.BatchIndex(spark, str(tmp_path))
    index.state["buckets"] = 64
    add(spark, index, 0, 1)
    probes = spark.createDataFrame([("=a",)], "token string")
    plan = probes.repartition(64, "token").hint("merge").join(index._touched(index._held(index.state["runs"]), probes), "token")._jdf.queryExecution().toString()
    assert "SelectedBucketsCount: 1 out of 64" in plan
    add(spark, index, 2)
    assert first_rows(index) == expected(range(3))


def test_repeated_postings_adds_only_new_batches(spark, tmp_path, monkeypatch):
    jobs = spark.createDataFrame([(i, n, "s", k) for n, rows_ in enumerate(BATCHES) for i, k in rows_], "row_id bigint, batch_no int, source string, native_id string")
    config = spark.createDataFrame([], "source string, board string")
    added = []
    add_batch = batches.BatchIndex.add_batch
    monkeypatch.setattr(batches.BatchIndex, "add_batch", lambda self, rows, n: (added.append(n), add_batch(self, rows, n)))
    batches.repeated_postings(jobs.where("batch_no < 3"), config, str(tmp_path))
    got = rows(batches.repeated_postings(jobs, config, str(tmp_path)))
    assert added == [0, 1, 2, 3, 4] and got == rows(batches.repeated_postings(jobs, config))
    assert got == [(1, 3), (1, 6), (1, 12), (2, 4), (5, 7), (8, 9), (10, 11)]


@pytest.mark.parametrize("threshold", [1.0, 0.8])
def test_waiting_batches_are_taken_in_lots_that_double(spark, tmp_path, monkeypatch, threshold):
    rng = random.Random(9)
    sets = [sorted(rng.sample("abcdefg", rng.choice((4, 5, 6)))) for _ in range(60)]
    df = spark.createDataFrame([(i, i // 4, "".join(x), x) for i, x in enumerate(sets)], "row_id bigint, batch int, key string, tokens array<string>")
    runs, write = [], batches.BatchIndex._write
    monkeypatch.setattr(batches.BatchIndex, "_write", lambda self, postings, run: (runs.append(run), write(self, postings, run)))
    index = batches.BatchIndex(spark, str(tmp_path), threshold, lots=True)
    for n in range(15):
        index.add_batch(df, n)
    index.settle()
    like = lambda a, b: len(set(a) & set(b)) >= threshold * len(set(a) | set(b))
    want = {(i // 4, "".join(x)): min(j for j in range(i + 1) if like(x, sets[j])) for i, x in reversed(list(enumerate(sets)))}
    assert first_rows(index) == want and index.batches == list(range(15))
    assert len(runs) == 5  # 1, 1, 2, 4 and the last 7


# ------------------------------------------------------------- p6 encoding


@settings(max_examples=100, deadline=None)
@given(st.text("aéñüß–“”•€", min_size=1, max_size=8), st.sampled_from(encoding.CHAINS))
def test_garbled_text_is_suspicious(text, chain):
    form = encoding.garble(text, chain)
    assert form == text if text.isascii() else form is None or encoding.could_be_garbled(form)


def test_restore_round_trip(spark):
    clean = ["Développeur confirmé à Paris", "Größe – “gut”", "Gestão de operações €5", "niño • año", "plain"]
    table = [(i, c, "x") for i, c in enumerate(clean)]
    want = {}
    for k, chain in enumerate(encoding.CHAINS):
        for j, c in enumerate(clean[:4]):
            g = encoding.garble(c, chain)
            if g is not None:
                table.append((100 + 10 * k + j, g + " tail", "x"))
                want[100 + 10 * k + j] = c + " tail"
    table += [(50, "caf� noir", "x"), (51, None, "x"), (52, "", "x"), (53, clean[0], "x"), (54, "Ü" * 3000, "x")]
    df = spark.createDataFrame(table, "row_id bigint, title string, text string")
    got = {r.row_id: r.restored for r in encoding.restore_encoding(df, ["title"]).collect()}
    assert got.pop(50) is None and got == want
    assert encoding.restored_digest(encoding.restore_encoding(df.where("row_id = 50"), ["title"])).first().restored_md5 == "lost"
    assert encoding.restore_encoding(df.limit(0), ["title"]).count() == 0


# ------------------------------------------------------------- p7 residue


@pytest.mark.parametrize(
    ("text", "kinds"),
    [
        ("<p>Join {{company_name}} and help us grow.</p>", {"placeholder"}), ("<p>We render mail with {{ name }} style placeholders.</p>", set()), ("<pre>{{ .Values.x }} ${y}</pre><p>Real work.</p>", set()), ("Join undefined and help us grow.", {"placeholder"}), ("You write undefined-safe code.", set()),
        ("<p>Real words here.</p><p>Lorem ipsum dolor sit amet consectetur</p>", {"filler"}), ("You replace lorem ipsum in mock-ups with words.", set()), ("test test test", {"filler"}), ("Java and Java fit together.", set()),
        ("<h1>404 Not Found</h1><p>The page could not be found.</p>", {"error_page"}), ('{"error": {"code": 429}}', {"error_page"}), ("You need to enable JavaScript to run this app.", {"script_notice"}), ("Please enable JavaScript to see the apply button.", {"script_notice"}),
        ("<h1>503 Service Unavailable</h1><p>The server is temporarily unable to service your request due to maintenance downtime or capacity problems. Please try again later. If the problem persists, contact the site administrator and give the reference and the time of your visit. Apache/2.4 Server at www.example.com Port 80</p>", {"error_page"}),
        ("<p>Checking your browser before accessing example.com. This process is automatic. Your browser will redirect to your requested content shortly. Please turn JavaScript on and reload the page. DDoS protection by Cloudflare. Ray ID: 7f3a9c</p>", {"script_notice"}),
        ("<p>We grow.</p><p>Cupcake ipsum dolor sit amet marshmallow topping. Chocolate bar tiramisu jelly beans candy canes gummi bears sweet roll. Caramels dessert lollipop toffee croissant biscuit.</p>", {"filler"}),
        ("<p>Far far away, behind the word mountains, far from the countries Vokalia and Consonantia, there live the blind texts. Separated they live in Bookmarksgrove right at the coast of the Semantics, a large language river.</p>", {"filler"}),
        ("<p>Dear {first_name}, thank you.</p>", {"placeholder"}), ("<p>We are based in [City] and grow.</p>", {"placeholder"}), ("See [City](http://x) and [[City]] for more.", set()), ("We are \\textbf{city} planners.", set()),
        ("<p>You fix access denied errors and session expired bugs every day. You write Java and help our clients with reports. We pay well and the team is friendly.</p><ul><li>Java</li></ul>", set()),
        ("<p>" + "We write good software for farmers every day. " * 9 + "</p><noscript>Please enable JavaScript to see the apply button.</noscript>", set()), ("", set()), ("   ", set()),
    ],
)
def test_residue(spark, text, kinds):
    table = [(1, text), (2, "Join ${team} and help us grow."), (3, None)]
    got = rows(residue.find_residue(spark.createDataFrame(table, "row_id bigint, description_html string")))
    assert {k for i, k in got if i == 1} == kinds and (2, "placeholder") in got


def test_labels_spread_through_components(spark):
    base = [f"w{i}" for i in range(60)]
    near = [base, base[:-1] + ["x"], base[:-2] + ["y", "x"], [f"q{i}" for i in range(60)]]
    units = [("whole", " ".join(w), "error_page" if i == 0 else None, simhash.simhash(base) ^ (0 if i < 3 else -1), simhash.shingles(w)) for i, w in enumerate(near)]
    df = spark.createDataFrame(units, "scope string, unit string, kind string, fp bigint, grams array<string>")
    assert residue.propagate(df).count() == 3
    assert residue.find_residue(spark.createDataFrame([], "row_id bigint, description_html string")).count() == 0


def test_simhash_tables_find_all_within_the_radius(spark):
    rng = random.Random(4)
    base = [rng.getrandbits(64) - 2**63 for _ in range(40)]
    flip = lambda x, n: x ^ sum((1 << b) if b < 63 else -(1 << 63) for b in rng.sample(range(64), n))
    other = [(i, flip(x, n), n) for i, x in enumerate(base) for n in (0, 1, 3, 9)]
    a = spark.createDataFrame(list(enumerate(base)), "i int, l_fp bigint").withColumn("b", F.explode(simhash.block_keys(F.col("l_fp"))))
    b = spark.createDataFrame(other, "j int, fp bigint, n int").withColumn("b", F.explode(simhash.block_keys(F.col("fp"))))
    found = {(r.j, r.n) for r in a.join(b, "b").where("i = j").where(simhash.hamming(F.col("fp"), F.col("l_fp")) <= simhash.RADIUS).collect()}
    assert found == {(i, n) for i, _, n in other if n <= simhash.RADIUS}


def test_labels_reach_every_similar_unit_like_brute_force(spark):
    r = random.Random(7)
    units = {}
    for size in (6, 9, 12, 20, 30, 50, 80):
        for k in range(12):
            seed = [f"s{size}k{k}w{r.randrange(40)}" for _ in range(size)]
            units[" ".join(seed)] = "filler"
            for i in (0, size // 2, size - 1):
                for other in (seed + ["more"], seed[:i] + ["else"] + seed[i + 1 :], seed[:i] + seed[i + 1 :]):
                    units.setdefault(" ".join(other), None)
    grams = {u: set(simhash.shingles(u.split())) for u in units}
    want = {u for u, kind in units.items() if kind}
    new = set(want)
    while new:
        new = {u for u in units if u not in want and any(len(grams[u] & grams[v]) >= 0.8 * len(grams[u] | grams[v]) for v in new)}
        want |= new
    df = spark.createDataFrame([("paragraph", u, kind, simhash.simhash(u.split()), simhash.shingles(u.split())) for u, kind in units.items()], "scope string, unit string, kind string, fp bigint, grams array<string>")
    assert len(want) > 200 and {u.unit for u in residue.propagate(df).collect()} == want


def test_labels_go_on_to_paragraphs_and_pages_that_do_not_look_like_residue(spark):
    dummy = "lorem ipsum dolor sit amet consectetur adipiscing elit sed do eiusmod tempor".split()
    plain = [f"plainword{'abcdefghijklmnopqrstuvwxyz'[i % 26] * (1 + i // 26)}" for i in range(60)]
    chain = [dummy * 3 + plain[:14]]  # seven tenths dummy words
    for i in range(1, 11):  # each gives up three of its words at the front for others at the end
        chain.append(chain[-1][3:] + [f"later{'abcdefghijklmnopqrstuvwxyz'[i]}{c}" for c in "xyz"])
    page = "404 Not Found on this server. Please check the address and try again later or contact the site administrator for help with the link and the browser settings, the cache and the cookies of your browser"
    texts = [" ".join(c) for c in chain] + [page, "404 Nt Found" + page[13:], "We write software for farmers and pay well for it, every day of the year."]
    df = spark.createDataFrame(list(enumerate(f"<p>{t}</p>" for t in texts)), "row_id bigint, description_html string")
    grams = [set(simhash.shingles(residue.WORD.findall(residue.frame(t)))) for t in texts]
    like = lambda i, j: len(grams[i] & grams[j]) >= 0.8 * len(grams[i] | grams[j])
    want = {i: k for i, t in enumerate(texts) for _, _, k, _ in residue.units_of(t) if k}
    new = set(want)
    while new:
        new = {j for j in range(len(texts)) if j not in want and any(like(i, j) and (want.update({j: want[i]}) or True) for i in new)}
    assert rows(residue.find_residue(df)) == sorted(want.items()) and sorted(want) == list(range(13))


def test_prefixes_of_hashes_meet_like_brute_force():
    r = random.Random(8)
    for _ in range(300):
        a = [f"w{r.randrange(30)}" for _ in range(r.randrange(1, 60))]
        b = a[:]
        for _ in range(r.randrange(3)):
            b[r.randrange(len(b))] = "else"
        x, y = set(simhash.shingles(a)), set(simhash.shingles(b))
        if len(x & y) >= 0.8 * len(x | y):
            assert set(simhash.prefix_hashes(a)) & set(simhash.prefix_hashes(b))


def test_marks_of_many_texts_read_every_word_once():
    """What the pass over all texts takes: a whole text's words are its paragraphs' words."""
    r, marks, want = random.Random(9), residue.Marks(), {}

    def brute(words):
        hashes, size = [simhash.xxhash.xxh64_intdigest(w) for w in words], min(5, len(words))
        sums = sorted({sum(h * p for h, p in zip(hashes[i : i + size], simhash.PLACES, strict=False)) % 2**64 for i in range(len(words) - size + 1)})
        return {h - 2**64 * (h >= 2**63) for h in sums[: len(sums) - math.ceil(0.8 * len(sums) - 1e-9) + 1]}

    for row in range(200):
        # a trace (3fa9) is masked in the whole text, but only its digits are in the paragraph
        parts = [" ".join(r.choice(["3fa9", "12", "{{ name }}", "Ship", "write", "the", "plan", "lorem", "ipsum"][row % 2 :]) for _ in range(r.randrange(1, 30))) + "." for _ in range(r.randrange(1, 5))]
        text = "\n".join(parts + parts[:1] * (row % 3 == 0) + ["Please enable JavaScript to see this page."] * (row % 5 == 0))
        pieces, likely, page = residue.look(text)
        before = marks.n
        marks.add(row, pieces, page)
        if row % 2 and row % 5:
            assert marks.n - before == sum(len(residue.WORD.findall(residue.frame(p))) for p in residue.readable(text))
        others = [(scope, residue.WORD.findall(unit)) for scope, unit, _, looks in residue.units_of(text) if not looks]
        want[row] = {h if scope == "paragraph" else ~h for scope, words in others for h in brute(words) if words}
    got = {row: set(found.tolist()) for row, _, _, _, found in marks.take()}
    assert got == {row: found for row, found in want.items() if found} and marks.take() == []


def test_texts_read_again_are_the_same_sent_or_shuffled(spark, monkeypatch):
    body = "the harbour crew kept the old ledger open while the evening tide came in over the stones and the lamps were lit along the quay by"
    texts = [f"{body} {{{{ name }}}}.", f"{body} undefined.", f"{body} undefined. We hire cooks.", "We hire cooks who know their knives and like the early hours.", "lorem ipsum dolor sit amet"]
    df = spark.createDataFrame(list(enumerate(texts)), "row_id bigint, description_html string")
    sent = rows(residue.find_residue(df))
    monkeypatch.setattr(residue, "SENT_MARKS", -1)
    assert sent == rows(residue.find_residue(df)) and {(0, "placeholder"), (4, "filler")} <= set(sent)


# ------------------------------------------------------------- p8 packing


@settings(max_examples=60, deadline=None)
@given(st.lists(st.integers(1, 20), max_size=60), st.integers(20, 40))
def test_sum_of_squares_packs_validly(sizes, capacity):
    got = packing.sum_of_squares(np.array(sizes, int), capacity)
    load = Counter()
    for b, s in zip(got, sizes, strict=True):
        load[b] += s
    assert all(v <= capacity for v in load.values()) and len(load) <= max(1, 2 * -(-sum(sizes) // capacity)) + 1


def test_pack(spark):
    rng = random.Random(2)
    docs = spark.createDataFrame([(i, "word " * rng.choice((1, 7, 30, 90, 400))) for i in range(80)] + [(80, ""), (81, None), (None, "x"), (0, "again")], "doc_id bigint, text string")
    bins = spark.createDataFrame([("a", 64), ("b", 200), (None, 5), ("c", 0)], "bin_kind string, capacity_tokens int")
    packed = packing.pack(docs, bins, bins_per_shard=20).collect()
    sizes = {r.doc_id: r.n_tokens for r in packing.token_counts(docs.where("text <> 'again'")).where("n_tokens > 0").collect()}
    for kind, cap in (("a", 64), ("b", 200)):
        mine = [r for r in packed if r.bin_kind == kind and not (r.doc_id == 0 and r.token_end <= 2 and sizes[0] > 2)]
        load = Counter()
        for r in packed:
            if r.bin_kind == kind:
                load[r.bin_id] += r.token_end - r.token_start
        assert max(load.values()) <= cap
        total = Counter()
        for r in mine:
            total[r.doc_id] += r.token_end - r.token_start
            assert (sizes[r.doc_id] > cap) or (r.token_start, r.token_end) == (0, sizes[r.doc_id]) or r.doc_id == 0
        assert all(total[d] == n for d, n in sizes.items() if d != 0)
    assert {r.bin_kind for r in packed} == {"a", "b"}
    assert packing.pack(docs.limit(0), bins).count() == 0 and packing.pack(docs, bins.limit(0)).count() == 0
    one, five = (rows(packing.pack(docs.repartition(n), bins, bins_per_shard=20)) for n in (1, 5))
    assert one == five
    report = {r.bin_kind: r.fill for r in packing.fill_report(packing.pack(docs, bins), bins).collect()}
    assert report["b"] > 0.9


# ------------------------------------------------------------- p9 leaks


def test_shingle_similarity_counts_repeats(spark):
    a, b = "a a a a a a a b", "a a a a a b"
    x, y = (Counter(" ".join(t.split()[i : i + 5]) for i in range(len(t.split()) - 4)) for t in (a, b))
    want = sum((x & y).values()) / sum((x | y).values())
    df = spark.createDataFrame([(a, b), (a, a), ("p q", "r s")], "a string, b string")
    assert [r.s for r in df.select(leaks.shingle_similarity(F.col("a"), F.col("b")).alias("s")).collect()] == [want, 1.0, 0.0] and want == 0.5


def test_leaks_like_brute_force(spark):
    rng = random.Random(5)
    word = lambda: "".join(rng.choice("abcdefghij") for _ in range(4))
    items = [[word() for _ in range(rng.choice((5, 13, 30)))] for _ in range(20)]
    docs = []
    for i in range(60):
        t = [word() for _ in range(40)]
        it = rng.choice(items)
        k = rng.choice((6, 12, 13, 14, 30))
        t[10:10] = it[:k]
        docs.append(" ".join(w.upper() if rng.random() < 0.2 else w[:2] + "­" + w[2:] if rng.random() < 0.2 else w + rng.choice(("", ",", " —")) for w in t))
    docs[0] = " ".join(items[2]) if len(items[2]) >= 13 else docs[0]
    d = spark.createDataFrame([(i, t, "x") for i, t in enumerate(docs)] + [(0, docs[0], "x"), (900, None, "x"), (901, "", "x")], "doc_id bigint, text string, item_id string")
    it = spark.createDataFrame([(i, " ".join(w)) for i, w in enumerate(items)] + [(99, None)], "item_id int, item_text string")
    grams = lambda w: {tuple(w[k : k + 13]) for k in range(len(w) - 12)}
    want = sorted((i, j) for i, t in enumerate(docs) for j, w in enumerate(items) if grams(leaks.words_of(t)) & grams(w))
    assert rows(leaks.find_leaks(d, it)) == want and want
    assert set(want) <= set(rows(leaks.find_leaks(d, it, radius=3)))
    assert rows(leaks.find_leaks(d, it, filter_windows=60)) == want  # in several lots
    assert leaks.find_leaks(d, it.limit(0)).count() == 0 and leaks.find_leaks(d.limit(0), it).count() == 0


@settings(max_examples=60, deadline=None)
@given(st.integers(-(2**63), 2**63 - 1), st.sets(st.integers(0, 63), max_size=3))
def test_blocks_find_all_within_radius(fp, flips):
    other = fp
    for b in flips:
        other ^= 1 << b if b < 63 else -(2**63)
    a, b = (leaks.blocks(np.array([x], np.int64), 3) for x in (fp, other))
    assert any(x[0] == y[0] for x, y in zip(a, b, strict=True))


# ------------------------------------------------------------- p10 personal information


def test_pii_held_out_accuracy():
    fitted = pii.models()
    held = pii.training_texts(1500, seed=1234)
    found = pii.find_in([t for t, _ in held], fitted)
    for kind, least in (("email", 0.93), ("phone", 0.9), ("id_number", 0.97), ("address", 0.97), ("person", 0.95)):
        truth = {(i, s) for i, (_, spans) in enumerate(held) for s in spans if s[0] == kind}
        got = {(i, s) for i, spans in enumerate(found) for s in spans if s[0] == kind}
        assert len(truth & got) >= least * len(truth) and len(truth & got) >= 0.97 * len(got), kind


#: Sentences that share no frame with the training table; spans in tags named by their kind.
OUTSIDE = [
    "Anyone in doubt may ring <phone>(020) 7946-0123</phone> until Friday.", "I met <person>Ingrid Solberg</person> at the fair and liked the stand.", "The lease names <person>Tendai Moyo</person> and <person>Farai Moyo</person> as tenants.",
    "Her new place is <address>12 Marlow Road, Oakham LE15 6QT</address>.", "Letters reach us at <address>P.O. Box 4471-00100, Nairobi</address>.", "Questions? <person>Kwabena Asante</person> has answers.", "<person>Siobhan O'Rourke</person> took notes during the call.",
    "I owe <person>Mei Tan</person> an answer.", "As <person>Olumide Bakare</person> told me, the doors open at nine.", "<person>Zanele Khumalo</person> is our newest trainer.", "Ask at the desk for <person>Ravi Menon</person>.", "Regards from <person>Lindiwe Sithole</person>.",
    "Ticket raised by <person>Hannah Becker</person>, phone <phone>+49 30 23125778</phone>.", "The visa of <person>Dmitri Volkov</person> runs out in June.", "<person>VARGAS, Elena</person> (<email>elena.vargas@firm.example</email>)", "Write to the address <email>jobs+north@people.example</email> only.",
    "My passport number is <id_number>LX0471182</id_number>.", "Social security number <id_number>912-55-1840</id_number> goes on page two.", "NI number <id_number>QQ 12 34 56 C</id_number> was typed wrong.", "Tax PIN <id_number>A012345678Z</id_number> belongs to the firm's owner.", "SSN: <id_number>987-65-4320</id_number>",
    "The chair, <person>Amahle Dube</person>, opened the meeting.", "Both <person>Peter Novak</person> and <person>Jana Novakova</person> passed the typing test.", "Handed to <person>Grace Wambui</person> on Monday.", "Drafted by <person>Luis Ortega</person>, checked by <person>Carmen Ruiz</person>.",
    "Her cell is <phone>+1 (415) 555-0188</phone>.", "Landline <phone>030 23125 119</phone>.", "Mobile: <phone>0912 345 678</phone>", "Reachable at <phone>+254 912 004 118</phone> most evenings.", "Skype or <phone>+44 20 7946 0991</phone>.",
    "Send samples to <address>Plot 9, Baobab Road, Kisumu</address> by courier.", "She moved to <address>44 Elm Street, Reading RG1 4AA</address> in May.", "Our lawyer sits at <address>Lindenstraße 18, 10969 Berlin</address>.", "The shop at <address>77 rue de Rivoli, 75001 Paris</address> has closed.", "Envíelo a <address>Calle Mayor 14, 28013 Madrid</address> esta semana.",
    "Entreguem tudo em <address>Rua Augusta, 120, Lisboa</address>.", "Meine Anschrift: <address>Gartenweg 5b, 44135 Dortmund</address>", "Mail for <person>Tomasz Kowalski</person>: <email>t.kowalski@post.example</email>", "Forward it to <email>ada_lee(at)shop(dot)test</email>.", "cc <email>first.last@corp.example</email> on every mail",
    "The Blue Nile Hotel opens in spring.", "We compared Apache Kafka with Google Pub Sub.", "Great Rift Valley tours start daily.", "Our Nairobi Office Park lease ends.", "The Silver Birch Group bought Marlow Partners.", "Error 5512-884 came back twice.", "Order 4471-00100 left the shop.", "Version 10.0.2.117 is out.", "Die Große Halle bleibt zu.",
    "Senior Data Engineer wanted.", "The Peter Principle is a book.", "Room 120 holds 40 chairs.", "Call centre staff work in shifts.", "The price rose from 120 000 to 150 000.", "Grace had no time.", "See chapter 12.4 of the guide.", "May Day is a holiday.", "Use logo@3x.png there.", "Central Bank rules apply.", "Mount Kenya Trail Race starts soon.",
    "Please get in touch with <person>Xiomara Quispe</person>", "<person>Thandiwe Mokoena</person>, she sits on the second floor.", "<person>Priyanka Raghunathan</person> will interview you", "our manager <person>Hiroshi Nakamura</person>", "<person>Chen Wei</person> leads the team",
    "Send it to <address>1600 Pennsylvania Avenue NW, Washington, DC 20500</address>.", "Personalausweis <id_number>L01X00T471</id_number> liegt vor", "phone: <phone>555-2671</phone>",
]


def untagged(text):
    plain, spans = "", set()
    for part in re.split(r"(</?(?:person|email|phone|id_number|address)>)", text):
        if part.startswith("</"):
            spans.add((part[2:-1], begun, len(plain)))
        elif part.startswith("<") and part[1:-1] in pii.KINDS:
            begun = len(plain)
        else:
            plain += part
    return plain, spans


def test_pii_outside_the_training_frames():
    texts, truths = zip(*map(untagged, OUTSIDE), strict=True)
    found = [set(s) for s in pii.find_in(list(texts), pii.models())]
    for kind in pii.KINDS:
        truth, got = ({(i, s) for i, spans in enumerate(x) for s in spans if s[0] == kind} for x in (truths, found))
        assert len(truth & got) >= 0.9 * len(truth) and len(truth & got) >= 0.9 * len(got), (kind, truth ^ got)


@pytest.mark.parametrize(
    ("text", "want"),
    [
        ("Write to Anna.Li+x@Mail.Example now.", {("email", "Anna.Li+x@Mail.Example")}), ("Contact: bob(at)site(dot)test / +254 912 345 678", {("email", "bob(at)site(dot)test"), ("phone", "+254 912 345 678")}), ("Reference: Rosa M. O'Kleius, phone (020) 7946-0123.", {("person", "Rosa M. O'Kleius"), ("phone", "(020) 7946-0123")}),
        ("Payroll needs SSN 912-34-5678 and a letter.", {("id_number", "912-34-5678")}), ("Send it to Plot 12, Kazi Road, Mjini.", {("address", "Plot 12, Kazi Road, Mjini")}), ("Ask for Jonas at the desk; everybody knows him.", set()), ("Order no. 95-44-1890 was closed on 2025-03-14 10:30.", set()), ("Salaries run from 120 000 to 150 000 shillings.", set()),
    ],
)
def test_pii_spans(text, want):
    got = pii.find_in([text], pii.models())[0]
    assert {(k, text[a:b]) for k, a, b in got} == want
    assert pii.redact("ab@c.de x", [("email", 0, 7)]) == "[EMAIL] x"


@pytest.mark.parametrize(
    ("kind", "spans"),
    [
        ("phone", [f"+254 7{i}2 345 67{i}" for i in range(6)]), ("address", ["Hauptstr. 12, 44135 Dortmund"]), ("address", ["12 place de Vosges, 75004 Paris"]),
        *(("person", [cue, "Xolq Vrampt"]) for cue in ("by", "manager", "name:", "c/o", "attn:", "took over from")),
    ],
)
def test_pii_marks_cover_the_patterns(kind, spans):
    text = "x " * 70 + (" " if kind == "person" else " / ").join(spans) + " zz " * 40
    found = {(k, text[a:b]) for k, a, b in pii.candidates(text, pii.lowered(text))}
    assert {(kind, s) for s in (spans[1:] if kind == "person" else spans)} <= found


def test_pii_cues_are_whole_words():
    text = "Move surveys from Gricigind to Ruby without waking anybody at night."
    assert not [c for c in pii.candidates(text, pii.lowered(text)) if c[0] == "person"]


def test_pii_edges(spark):
    docs = spark.createDataFrame([(1, None, "k"), (2, "", "k"), (None, "Write to a.b@c.example", "k"), (3, "😀 Write to a.b@c.example. " + "filler words " * 40_000, "k"), (3, "😀 Write to a.b@c.example. " + "filler words " * 40_000, "k")], "doc_id bigint, text string, kind string")
    assert rows(pii.find_personal(docs)) == [(3, "email", 11, 24)]
    assert pii.find_personal(docs.limit(0)).count() == 0


def test_boost_separates():
    rng = np.random.default_rng(0)
    x = rng.normal(size=(400, 3))
    y = ((x[:, 0] > 0) ^ (x[:, 1] > 0)).astype(float)
    p = Boost(rounds=40).fit(x[:300], y[:300]).probability(x[300:])
    assert ((p >= best_threshold(p, y[300:])) == y[300:]).mean() > 0.9
