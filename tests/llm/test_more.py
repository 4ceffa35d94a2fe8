"""Registered queries and edge cases against brute force, planted models, and pages labelled by hand."""

import hashlib
import random
import re
from collections import Counter, defaultdict

import pandas as pd
import pytest
from pyspark.sql import functions as F

from strandgraph.llm import decontam, html_crf, language_id, minhash, quality_rules, queries, secret_scan, warc

SF = "/root/testdata/sf0.001"
WORD = re.compile(r"[^\x20\x09-\x0D]+")


def documents(sf=SF):
    return pd.read_parquet(f"{sf}/documents.parquet", columns=["doc_id", "text"])


def test_registered_secret_scan_equals_brute_force(spark):
    rules = secret_scan.BASE + secret_scan.EXTRA
    patterns = [(r.kind, re.compile(f"(?:{r.head})({r.tail}+)", re.A), r.least) for r in rules]
    sf = "/root/testdata/sf0.01"
    got = {r.doc_id: r for r in queries.op2_secret_scan(spark, sf).collect()}
    found = 0
    for doc_id, text in documents(sf).itertuples(index=False):
        spans = sorted((m.start(), k, m.end()) for k, (_, p, least) in enumerate(patterns) for m in p.finditer(text or "") if len(m[1]) >= least)
        named = [f"{rules[k].kind}:{a}:{b}" for a, k, b in spans]
        base = [x for x, (_, k, _) in zip(named, spans) if k < 3]
        r = got[doc_id]
        assert r.spans == ",".join(named) and r.base_sha256 == hashlib.sha256(",".join(base).encode()).hexdigest()
        assert [r.n_assign, r.n_access, r.n_hex] == [sum(k == i for _, k, _ in spans) for i in range(3)]
        found += len(spans)
    assert found > 5 and len(got) == len(documents(sf))


def test_extra_kinds_and_empty_tables(spark):
    texts = ["ghp_" + "z1" * 18 + "!", "xoxb-1234567890a", "AIza" + "x" * 35, "eyJhbGci.eyJ" + "b" * 20, "-----BEGIN RSA PRIVATE KEY-----", "token=ab secret=token: abcdefgh12", None, ""]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    kinds = {r.key: [s.kind for s in r.spans] for r in secret_scan.scan(docs).collect()}
    assert [kinds[i] for i in range(5)] == [["github"], ["slack"], ["google"], ["jwt"], ["pem"]]
    assert kinds[5] == [] and kinds[6] == [] and kinds[7] == []  # a short match takes its letters with it
    assert secret_scan.scan(docs.limit(0)).count() == 0 and quality_rules.score(docs.limit(0)).count() == 0


def test_registered_quality_base_equals_brute_force(spark):
    got = {r.doc_id: r for r in queries.op1_quality_rules(spark, SF).collect()}
    for doc_id, text in documents().itertuples(index=False):
        w, r = WORD.findall(text or ""), got[doc_id]
        seen, cover = Counter(zip(w, w[1:], w[2:])), set()
        for i, g in enumerate(zip(w, w[1:], w[2:])):
            if seen[g] > 1:
                cover |= {i, i + 1, i + 2}
        lines = [x for x in (text or "").split("\n") if WORD.search(x)]
        assert (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words) == (len(w), sum(map(len, w)), sum(c in "#*$%&|<>" for c in text or ""), len(lines) - len(set(lines)), len(cover))


@pytest.mark.parametrize("junk", [0.1, 0.4, 0.6, 0.8, 0.95])
def test_em_recovers_planted_accuracies(spark, junk):
    """Votes drawn from known rates: the model gives them back, and each document's side, whatever the share of junk."""
    rng = random.Random(6)
    names = list("abcdefghi")
    rates = {n: ((rng.uniform(0.3, 0.8), rng.uniform(0.005, 0.08)), (rng.uniform(0.05, 0.3), rng.uniform(0.2, 0.6))) for n in names}
    rows = []
    for _ in range(8000):
        good = rng.random() >= junk
        votes = []
        for of_good, of_bad in rates.values():
            up, down = of_good if good else of_bad
            x = rng.random()
            votes.append(1 if x < up else -1 if x < up + down else 0)
        rows.append((votes, good))
    df = spark.createDataFrame(rows, "votes array<int>, good boolean")
    model = quality_rules.fit(df.select("votes"), names)
    assert abs(model["prior"] - (1 - junk)) < 0.02
    most = 0.05 if 0.2 < junk < 0.9 else 0.08  # of the rarer class there are few documents
    for n, (of_good, of_bad) in rates.items():
        for v, k in ((1, 0), (-1, 1)):
            p = model["votes"][n][v]
            assert abs(p[0] - of_good[k]) < most and abs(p[1] - of_bad[k]) < most
    odds = quality_rules._log_odds(F.col("votes"), names, model)
    assert df.select(F.avg(((odds > 0) == F.col("good")).cast("int"))).first()[0] > 0.95


def test_em_bound_settles_rules_that_hardly_disagree(spark):
    """One rule alone condemns 7 % of the documents; without a bound its votes could be a good document's habit."""
    rows = [([1, 0, 1],)] * 900 + [([0, 0, 1],)] * 30 + [([1, -1, 1],)] * 65 + [([0, -1, 0],)] * 5
    model = quality_rules.fit(spark.createDataFrame(rows, "votes array<int>"), ["a", "b", "c"], false_alarms=0.01)
    assert 0.92 < model["prior"] < 0.95 and model["votes"]["b"][-1][0] <= 0.01 and model["votes"]["b"][-1][1] > 0.8


def test_language_id_equals_a_plain_twin(spark):
    """Out-of-place distances by dictionaries and sorting."""
    texts = [("en", "the house and the garden " * 9), ("de", "das haus und der garten über alles " * 9), ("en", "they ran over the hill and sang "), ("de", "sie liefen über den hügel und sangen "), (None, "xyz qqq"), ("en", None), ("de", "123 !!")]
    docs = spark.createDataFrame([(i, t, x) for i, (x, t) in enumerate(texts)], "doc_id long, text string, lang string")

    def grams(t):
        out = Counter()
        for w in "".join(c if c.isalpha() else " " for c in t.lower()).split():
            s = f" {w} "
            out.update(w)
            out.update(s[i : i + 2] for i in range(len(s) - 1))
            out.update(s[i : i + 3] for i in range(len(s) - 2))
        return out

    code = lambda g: sum((0 if c == " " else ord(c)) << 21 * (len(g) - 1 - i) for i, c in enumerate(g)) | (1 << 62 if len(g) == 2 else 0)
    ranked = lambda c, n: [g for g, _ in sorted(c.items(), key=lambda x: (-x[1], code(x[0])))[:n]]
    held = {r.doc_id for r in docs.where(language_id.held_out(F.col("doc_id"))).collect()}
    total = defaultdict(Counter)
    for i, (x, t) in enumerate(texts):
        if x and t and i not in held:
            total[x] += grams(t)
    profiles = {x: ranked(c, language_id.PROFILE) for x, c in total.items()}
    learned = language_id.learn(docs)
    assert {x: [code(g) for g in p] for x, p in profiles.items()} == learned
    most = max(map(len, profiles.values()))
    for r in language_id.identify(docs, learned).collect():
        mine = ranked(grams(texts[r.key][1] or ""), language_id.RANKED)
        if not mine:
            assert (r.lang_pred, r.score) == ("und", 0)
            continue
        far = {x: sum(min(most, abs(p.index(g) - i)) if g in p else most for i, g in enumerate(mine)) for x, p in profiles.items()}
        best = min(sorted(far), key=far.get)
        assert r.lang_pred == best and abs(r.score - max(far.values()) / sum(far.values())) < 1e-9
    assert language_id.identify(docs.limit(0), learned).count() == 0


#: Layouts written by hand, none made by the training generator, with their main text.
PAGES = [
    ("<html><body><div id=top><a href=/>Home</a> <a href=/a>About</a></div><main><h1>A walk by the river</h1><p>The morning was cold, and the path ran along the water for a mile.</p><p>We met nobody until noon.</p></main><footer>&copy; 2023 All rights reserved</footer></body></html>", "A walk by the river The morning was cold, and the path ran along the water for a mile. We met nobody until noon."),
    ("<body><header><p>Daily Paper</p></header><nav><ul><li><a href=1>News</a><li><a href=2>Sport</a></ul></nav><article><h2>Rain ends drought</h2><p>Farmers in the north said on Monday that the rain came just in time for the crops.<p>Rivers rose by half a metre.</article><aside><h3>Most read</h3><ul><li><a href=3>Ten tips</a></ul></aside></body>", "Rain ends drought Farmers in the north said on Monday that the rain came just in time for the crops. Rivers rose by half a metre."),
    ("<div class=\"cookie-banner\">We use cookies to improve this site. <button>Accept</button></div><article class='post'><h1>Bread</h1><p>Mix the flour &amp; water, wait an hour, and knead it well.</p><blockquote>My grandmother never weighed anything in her whole life.</blockquote></article><section id=comments><h2>Comments</h2><div class=comment><p>Anna</p><p>I tried this and it was great, thank you very much!</p></div></section>", "Bread Mix the flour & water, wait an hour, and knead it well. My grandmother never weighed anything in her whole life."),
    ("<main><p title=don't>It isn't lost, and it's all still here for the reader.</p><hr><p>After the rule the second part goes on for a while.</p><script>var a = '<p>no</p>';</script></main><form class=search><label>Search</label><input></form>", "It isn't lost, and it's all still here for the reader. After the rule the second part goes on for a while."),
    ("<article><h1>Übersicht</h1><table><tr><td>Im Jahr 1990 wurden hier vierzig Häuser gebaut, die heute noch stehen.</td></tr></table><div class='advert'>Buy now and save half of the price today!</div><p>Danach wurde es still im Dorf.</p></article><footer><p>Impressum</p></footer>", "Übersicht Im Jahr 1990 wurden hier vierzig Häuser gebaut, die heute noch stehen. Danach wurde es still im Dorf."),
]


def test_pages_labelled_by_hand():
    """Block accuracy on layouts that the generator doesn't make."""
    crf, right, total = html_crf.model(), 0, 0
    for page, main in PAGES:
        seq = html_crf.blocks(page)
        for b, y in zip(seq, crf.label(seq)):
            right += (b.text in main) == bool(y)
            total += 1
    assert total >= 25 and right / total > 0.9


@pytest.mark.parametrize("page, texts", [("<p title=don't>a</p><p>it's</p>", ["a", "it's"]), ("<p a='x>y' b=\"<\">t</p>", ["t"]), ('<p a="b>t</p>', ["t"]), ("<p a = b/>t", ["t"]), ("a<hr>b<hr/>c", ["a", "b", "c"]), ("<p =x>t</p>", ["t"]), ("x<y", ["x"])])
def test_attributes(page, texts):
    assert [b.text for b in html_crf.blocks(page)] == texts


def test_extract_edge_cases(spark):
    """Null, empty, repeated and very long pages, a null id, and clashing names."""
    long = "<article><h1>Long</h1>" + "<p>This is a sentence of the article that goes on.</p>" * 4000 + "</article>"
    rows = [(1, "u", None, "t"), (2, None, "", "t"), (3, "u", PAGES[0][0], "t"), (3, "u", PAGES[0][0], "t"), (None, "u", long, "t")]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string, text string")
    got = html_crf.extract(pages).collect()
    assert sorted((r.page_id or 0, len(r.text)) for r in got) == [(0, 4 + 4000 * 48), (1, 0), (2, 0), (3, len(PAGES[0][1])), (3, len(PAGES[0][1]))]
    assert html_crf.extract(pages.limit(0)).count() == 0


def test_gaps_through_spark(spark, tmp_path):
    """A damaged archive's whole records and quarantined bytes."""
    parts = [warc.compress(warc.encode_record(i, "u", b"payload %d " % i * 40, 400, "d")) for i in range(4)]
    broken = bytearray(parts[1])
    broken[len(broken) // 2] ^= 0xFF
    (tmp_path / "a.warc.gz").write_bytes(b"".join([parts[0], bytes(broken), *parts[2:]]))
    files = spark.createDataFrame([(f"file://{tmp_path}/a.warc.gz",)], "file string")
    assert sorted(r.page_id for r in warc.read(files).collect()) == [0, 2, 3]
    gap = warc.gaps(files).collect()
    assert [(r.start, r.end) for r in gap] == [(len(parts[0]), len(parts[0]) + len(parts[1]))] and gap[0].reason


def components(sets):
    label = {k: k for k in sets}

    def find(x):
        while label[x] != x:
            x = label[x]
        return x

    keys = sorted(sets)
    for i, a in enumerate(keys):
        for b in keys[i + 1 :]:
            if sets[a] and 100 * len(sets[a] & sets[b]) >= 80 * len(sets[a] | sets[b]):
                x, y = find(a), find(b)
                label[max(x, y)] = min(x, y)
    return {k: find(k) for k in sets}


def test_crowded_buckets_equal_brute_force(spark, monkeypatch):
    """Texts around common passages, near the threshold and linked by rare or by frequent shingles only: the exact join of
    crowded buckets, forced by a small FEW, gives the components of all pairs."""
    monkeypatch.setattr(minhash, "FEW", 3)
    rng = random.Random(4)
    new = lambda: f"n{rng.getrandbits(50)}"
    rows = []
    for _ in range(3):
        passage = [new() for _ in range(120)]
        for _ in range(45):
            w = list(passage)
            for i in rng.sample(range(120), rng.choice([0, 1, 2, 3, 5, 8])):
                w[i] = new()
            rows.append(w + [new() for _ in range(rng.choice([0, 5, 12, 16, 20, 28, 40]))])
    for w in rng.sample(rows, 25):
        rows.append([*w[:-2], new(), new()])
    rng.shuffle(rows)
    sets = {i: {tuple(w[j : j + 4]) for j in range(len(w) - 3)} for i, w in enumerate(rows)}
    docs = spark.createDataFrame([(i, " ".join(w)) for i, w in enumerate(rows)], "doc_id long, text string")
    want = components(sets)
    got = {r.doc_id: r.component_id for r in minhash.near_duplicates(docs, k=4).collect()}
    assert got == want and 3 < len(set(want.values())) < len(rows)


def test_repeated_ids_count_as_their_smallest_text(spark):
    a, b = " ".join(f"a{i}" for i in range(50)), " ".join(f"b{i}" for i in range(50))
    docs = spark.createDataFrame([(1, a), (2, b), (2, a), (3, b), (4, None), (4, b), (None, a)], "doc_id long, text string")
    got = sorted((r.doc_id or 0, r.component_id, r.kept) for r in minhash.near_duplicates(docs).collect())
    assert got == [(0, None, True), (1, 1, True), (2, 1, False), (2, 1, False), (3, 3, True), (4, 3, False), (4, 3, False)]


def test_index_is_bounded_in_bytes():
    """The windows' arrays are at most 20 times the item text."""
    rng = random.Random(9)
    items = [(i, " ".join(f"w{rng.randint(0, 3000)}" for _ in range(100))) for i in range(1000)]
    vocabulary = decontam._vocabulary([t for _, t in items])
    index = decontam.Windows(items, 10, vocabulary, rng.choices(range(50), k=len(vocabulary)))
    assert index.bytes - len(index.filter) < 20 * sum(len(t) for _, t in items)


def test_pipeline_stages_equal_plain_python(spark, tmp_path):
    """Near duplicates and decontamination row by row, the classifier's and the mix's rows as bags, on nulls, repeated
    ids and ties; empty tables stay empty."""
    import corpus_pipeline
    from strandgraph.llm import cotrain, mixing

    rng = random.Random(1)
    base = [f"w{i}" for i in range(60)]
    items = spark.read.parquet(f"{SF}/benchmark.parquet")
    text = items.where("text IS NOT NULL").orderBy("item_id").first().text
    rows = [(1, " ".join(base), "en", "a", 5), (2, " ".join(base) + " end", "en", None, None), (2, "other words here", "de", "b", 1), (None, " ".join(base), None, "a", 2), (None, "x " + text + " y", None, "a", 2), (5, "x " + text + " y", "en", "a", 2), (6, None, None, None, None), (7, "", "en", "a", 0)]
    rows += [(10 + i, " ".join(rng.choice(base) + str(rng.randint(0, 99)) for _ in range(70)), "en", "b", i) for i in range(12)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    bag = lambda df: Counter(map(tuple, df.collect()))
    stage = dict(corpus_pipeline.STAGES)
    near = bag(stage["minhash near-dedup"](spark, docs, SF))
    groups = [(rows[0], rows[1], rows[3]), (rows[4], rows[5])]  # two texts of id 2 are two documents
    assert all(sum(near[r] for r in g) == 1 for g in groups)
    assert near == Counter(r for r in rows if not any(r in g for g in groups)) + Counter(r for g in groups for r in g if near[r])
    clean = bag(stage["benchmark decontamination"](spark, docs, SF))
    assert clean == Counter(r for r in rows if text not in (r[1] or ""))
    seen = cotrain.classify(docs.where("doc_id >= 10"), *(spark.read.parquet(f"{SF}/{n}.parquet") for n in ("labels", "pages")))
    assert seen.count() == 12
    kept = bag(stage["quality classifier"](spark, docs, SF))
    assert not kept - Counter(rows)
    assert bag(stage["mixing"](spark, docs, SF)) == Counter(rows) and mixing.mix(docs).count() == len(rows)
    for name, f in corpus_pipeline.STAGES:
        assert f(spark, docs.limit(0), SF).count() == 0, name


def test_near_dedup_stage_keeps_every_text_of_an_id(spark):
    """Rows of one id and null ids are documents of their own; equal rows are one."""
    import corpus_pipeline

    text = lambda c: " ".join(f"{c}{i}" for i in range(40))
    rows = [(7, text("a"), "s"), (7, text("b"), "s"), (7, text("b"), "r"), (7, text("b"), "r"), (None, text("c"), "s"), (None, text("c"), "s"), (None, text("d"), None), (3, text("d"), "s"), (9, None, "s"), (9, "", "s")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string")
    got = Counter(map(tuple, dict(corpus_pipeline.STAGES)["minhash near-dedup"](spark, docs, SF).collect()))
    assert got[rows[0]] == 1 and got[rows[2]] == 1 and got[rows[1]] == 0 and got[rows[4]] == 1 and got[rows[6]] + got[rows[7]] == 1 and got[rows[8]] == got[rows[9]] == 1
    assert sum(got.values()) == 6


@pytest.mark.parametrize("most", [0, 7])
def test_token_stage_keeps_the_order_of_the_mix(spark, tmp_path, most):
    """Each document's place, ids and digest against plain Python, also where tasks split their files."""
    import zlib
    from array import array

    import corpus_pipeline
    from strandgraph.llm import mixing
    from tokenizers import Tokenizer

    key = "spark.sql.files.maxRecordsPerFile"
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    spark.conf.set(key, str(most))
    try:
        dict(corpus_pipeline.STAGES)["mixing"](spark, docs, SF).write.parquet(str(tmp_path / "mixed"))
    finally:
        spark.conf.unset(key)
    encoder, at, want = Tokenizer.from_file(queries.tokenizer_path()), 0, {}
    text = dict(documents().itertuples(index=False))
    for r in mixing.mix(docs).select("doc_id", "mix_position").orderBy("mix_position").collect():
        ids = array("I", [*encoder.encode(text[r.doc_id] or "", add_special_tokens=False).ids, queries.END_ID])
        want[r.doc_id] = (at, len(ids), zlib.crc32(ids.tobytes()))
        at += len(ids)
    got = corpus_pipeline.tokens(spark, spark.read.parquet(str(tmp_path / "mixed")), SF).collect()
    assert {r.doc_id: (r.start, r.n_tokens, r.ids_crc32) for r in got} == want and len(got) == len(want)


def test_token_stage_takes_an_order_or_warns(spark):
    import corpus_pipeline

    docs = spark.createDataFrame([(1, "a b"), (3, "c"), (2, None)], "doc_id long, text string")
    order = lambda df: [r.doc_id for r in df.orderBy("start").collect()]
    assert order(corpus_pipeline.tokens(spark, docs, SF, [F.desc("doc_id")])) == [3, 2, 1]
    with pytest.warns(UserWarning, match="come from no file"):
        assert order(corpus_pipeline.tokens(spark, docs, SF)) == [1, 2, 3]


def test_classifier_stage_drops_what_the_classifier_rejects(spark):
    """The rows of every document that a run of the classifier keeps."""
    import corpus_pipeline
    from strandgraph.llm import cotrain

    tables = [spark.read.parquet(f"{SF}/{n}.parquet") for n in ("documents", "labels", "pages")]
    kept = {r.doc_id for r in cotrain.classify(*tables).where("kept").collect()}
    got = dict(corpus_pipeline.STAGES)["quality classifier"](spark, tables[0], SF)
    assert sorted(r.doc_id for r in got.collect()) == sorted(kept) and 0 < len(kept) < tables[0].count()


def test_a_run_leaves_only_its_last_tables(spark, tmp_path):
    """The whole pipeline equals its stages one by one, and deletes what no result reads."""
    import os

    import corpus_pipeline
    from strandgraph.sources import shared

    root = os.path.dirname(shared.folder(spark, "any")).removeprefix("file:")
    root = "/" + root.lstrip("/")
    before = set(os.listdir(root)) if os.path.isdir(root) else set()
    out = corpus_pipeline.run(spark, SF)
    left = sorted(name.rsplit("-", 1)[0] for name in set(os.listdir(root)) - before)
    got = {tuple(r) for r in out.select("doc_id", "start", "n_tokens").collect()}
    assert left == ["mixing", "token-files", "tokens"]
    seen = spark.read.parquet(f"{SF}/documents.parquet")
    for name, stage in corpus_pipeline.STAGES[:-1]:
        stage(spark, seen, SF).write.parquet(str(tmp_path / name))
        seen = spark.read.parquet(str(tmp_path / name))
    assert got == {tuple(r) for r in corpus_pipeline.tokens(spark, seen, SF).select("doc_id", "start", "n_tokens").collect()}
