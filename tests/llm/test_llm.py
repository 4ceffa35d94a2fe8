"""The ten operators on small fixtures: edge cases, and brute force where SQL has no form."""

import hashlib
import io
import random
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from strandgraph.llm import components, cotrain, decontam, html_crf, language_id, minhash, mixing, quality_rules, queries, secret_scan, token_store, warc
from strandgraph.llm.common import BROADCAST_ROWS, utf8_buffers

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, bucket string, kept int, part int, text_a string"


@pytest.fixture(scope="module")
def docs(spark):
    """Nulls, empties, ties, repeated rows, a very long text and columns with clashing names."""
    rng = random.Random(3)
    words = ["the", "cat", "Über", "naïve", "x1", "token=abcdefgh12", "and", "house", "garden", "ran", "quickly"]
    texts = [None, "", " \n\t ", "one", "two words", "a b c d", "a b c d", "A B C D", "!!! ???", "word " * 30_000]
    texts += [" ".join(rng.choice(words) + str(rng.randint(0, 60)) for _ in range(rng.randint(1, 80))) + rng.choice(["", "\nsame line\nsame line"]) for _ in range(80)]
    base = " ".join(f"w{i}" for i in range(120))
    texts += [base, base.replace("w60 ", "zz "), base.upper(), base + " end"]
    rows = [(i, t, ["en", "de", None][i % 3], ["a", "b", None, "a"][i % 4], len(t or ""), "b", 1, 2, "t") for i, t in enumerate(texts)]
    rows += [rows[20], (None, "null key text here", None, None, None, None, None, None, None)]
    return spark.createDataFrame(rows, SCHEMA).cache()


def lower(t):
    return re.sub("[A-Z]", lambda m: m[0].lower(), t or "")


def test_quality_measures(docs):
    got = {r.doc_id: r for r in quality_rules.score(docs).collect()}
    for r in docs.where("doc_id IS NOT NULL").collect():
        w = re.findall(r"[^\x20\x09-\x0D]+", r.text or "")
        grams = [tuple(w[i : i + 3]) for i in range(len(w) - 2)]
        seen, cover = Counter(grams), set()
        for i, g in enumerate(grams):
            if seen[g] > 1:
                cover |= {i, i + 1, i + 2}
        lines = [x for x in (r.text or "").split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
        x = got[r.doc_id]
        assert (x.n_words, x.word_chars, x.n_dup_lines, x.n_repeat_words) == (len(w), sum(map(len, w)), len(lines) - len(set(lines)), len(cover))
        assert x.base_failed == (len(w) < 50 or 100 * len(cover) > 50 * len(w)) and not (x.base_failed and x.kept)


def test_secrets_equal_regexes(docs):
    parts = ['password = "', "AKIA", "token:", "deadbeef" * 3, "0123456789abcdef", "é", "ſecret=abcdefgh1", "\n", " ", "APIKEY : ", '"', "abcdEFGH12", "ABCDEFGH1234", ","]
    rng = random.Random(1)
    texts = ["".join(rng.choice(parts) for _ in range(rng.randint(0, 14))) for _ in range(800)] + ["", "password=" + "a" * 50_000]
    base = [(r"(?:(?i:password|passwd|secret|token|api_?key))[\"']?\x20*[:=]\x20*[\"']?([A-Za-z0-9+/_.=-]+)", 8), ("AKIA([A-Z0-9]+)", 12), ("([0-9a-f]+)", 32)]
    got = secret_scan.Scanner().spans(*utf8_buffers(pa.array(texts)))
    for n, t in enumerate(texts):
        want = sorted((m.start(), k, m.end()) for k, (p, least) in enumerate(base) for m in re.finditer(p, t, re.A) if len(m[1]) >= least)
        assert [s for s in got.get(n, []) if s[1] < 3] == want
    assert secret_scan.scan(docs).count() == docs.count()
    assert secret_scan.redact("key token=abc x", [(4, 13), (6, 9)]) == "key [secret] x"


def test_warc_round_trip_and_salvage(spark):
    same = "<p>" + "x" * 200 + "</p>"
    rows = [(5, "http://a/é\r\n", same), (3, None, same), (9, "u", same), (1, "u", "short"), (2, "u", "short"), (4, "u", None), (None, "u", same), (7, "v", "y" * 300_000)]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string")
    got = {r.page_id: r for r in warc.round_trip(pages).collect()}
    assert len(got) == 8 and got[5].refers_to == 3 and got[9].refers_to == 3 and got[3].record_type == "response" and got[None].record_type == "response"
    assert got[9].payload_digest == hashlib.sha256(same.encode()).hexdigest() and got[9].payload_bytes == len(same)
    assert got[2].record_type == "response" and got[4].payload_bytes == 0 and got[7].payload_bytes == 300_000
    assert warc.round_trip(pages.limit(0)).count() == 0


class Source(io.BytesIO):
    def size(self):
        return len(self.getvalue())


@pytest.mark.parametrize("zipped", [True, False])
def test_salvage_goes_on_after_damage(zipped):
    plain = [warc.encode_record(i, "u", b"payload %d " % i * 40, 400, "d") for i in range(6)]
    parts = [warc.compress(p) if zipped else p for p in plain]
    broken = bytearray(parts[2])
    broken[len(broken) // 2] ^= 0xFF
    data = b"".join([parts[0], parts[1], bytes(broken), parts[3], b"junk bytes", parts[4], parts[5][:-9]])
    found = list(warc.salvage(Source(data)))
    assert [warc._id(r.headers["warc-record-id"]) for _, r, _, _ in found if r] == [0, 1, 3, 4]
    gaps = [(s, e) for s, r, e, _ in found if r is None]
    at = len(parts[0]) + len(parts[1])
    assert gaps[0] == (at, at + len(parts[2])) and gaps[1][1] - gaps[1][0] == 10 and gaps[2][1] == len(data)


def test_html_field():
    crf = html_crf.model()
    held = [html_crf.labelled(*p) for p in html_crf.training_pages(80, 99)]
    right = sum(a == b for f, y in held for a, b in zip(crf.viterbi(crf.unary(f)), y))
    assert right / sum(len(y) for _, y in held) > 0.98
    page = "<html><body><nav><a href=x>Home</a></nav><article><h1>Title &amp; more</h1><p>First   long\nparagraph of words.<p>Second one, <b>bo</b>ld &eacute;.</article><div class=comments><p>I like it a lot.</p></div><footer>&copy; 2024</footer>"
    assert html_crf.main_text(page, crf) == "Title & more First long paragraph of words. Second one, bold é."
    assert html_crf.main_text(None, crf) == "" and html_crf.main_text("<script>x</script>", crf) == ""


def test_token_store(spark, docs):
    from tokenizers import Tokenizer

    path = queries.tokenizer_path()
    plain = Tokenizer.from_file(path)
    got = {r.doc_id: r for r in token_store.round_trip(docs.where("doc_id IS NOT NULL").dropDuplicates(["doc_id"]), path, 2).collect()}
    at = 0
    for r in sorted(docs.where("doc_id IS NOT NULL").dropDuplicates(["doc_id"]).collect(), key=lambda r: r.doc_id):
        ids = plain.encode(r.text or "", add_special_tokens=False).ids + [2]
        x = got[r.doc_id]
        assert (x.start, x.n_tokens, x.ids_crc32) == (at, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes()))
        at += len(ids)
    odd = ["It's <|endoftext|> don't", "á\t\x1c b c", "İstanbul ΑΣ 12three!!", "x,y. (z) Word*** ÀÉ,", "  ", " a"]
    assert token_store.encoder(path).check(odd)
    assert token_store.round_trip(docs.limit(0), path, 2).count() == 0 and token_store.round_trip(docs, path, 2).count() == docs.count()


def test_token_store_checks_frames(tmp_path):
    w = token_store.StoreWriter(str(tmp_path), "f.zst", frame=64)
    for i in range(20):
        w.add(i, np.arange(i, i + 9, dtype="<u4").tobytes())
    w.close()
    data = (tmp_path / "f.zst").read_bytes()
    store = token_store.StoreReader(Source(data))
    assert store.ids(13) == np.arange(13, 22, dtype="<u4").tobytes() and len(store.frames) > 3
    import zstandard

    assert zstandard.ZstdDecompressor().stream_reader(io.BytesIO(data), read_across_frames=True).read()
    torn = bytearray(data)
    torn[store.frames[2][1] + store.frames[2][2] // 2] ^= 1
    bad = token_store.StoreReader(Source(bytes(torn)))
    with pytest.raises(Exception):
        bad.ids(int(np.searchsorted(bad.first, bad.frames[2][0])))


def test_language_id(spark, docs):
    real = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    found = language_id.identify(real, language_id.learn(real, per_language=50)).join(real.withColumnRenamed("doc_id", "key"), "key").where(language_id.held_out(F.col("key")))
    assert found.select(F.avg((F.col("lang") == F.col("lang_pred")).cast("int"))).first()[0] > 0.97
    got = {r.key: r for r in language_id.identify(docs, language_id.learn(docs)).collect()}
    assert got[0].lang_pred == got[1].lang_pred == got[8].lang_pred == "und" and got[0].score == 0
    assert language_id.identify(docs, {}).where("lang_pred <> 'und'").count() == 0
    assert language_id.learn(docs.limit(0)) == {}


def test_cotraining(spark, docs):
    """Accuracy on labels that training never saw, and edge cases."""
    tables = [spark.read.parquet(f"/root/testdata/sf0.01/{n}.parquet") for n in ("documents", "labels", "pages")]
    hidden = F.pmod(F.xxhash64("doc_id"), F.lit(4)) == 1
    seen = cotrain.features(tables[0], tables[1].where(~hidden), tables[2])
    model = cotrain.train(seen)
    held = cotrain.score(seen, model).join(tables[1].where(hidden), "doc_id")
    assert held.count() > 60 and held.select(F.avg((F.col("kept") == (F.col("quality") == 1)).cast("int"))).first()[0] > 0.95
    assert model.exchanged > 600  # all that either view is sure of
    assert cotrain.classify(docs, tables[1].limit(0), tables[2].limit(0)).where("kept AND score = 0.5").count() == docs.count()
    assert cotrain.classify(docs.limit(0), tables[1], tables[2]).count() == 0
    marks = docs.select("doc_id", (F.col("doc_id") % 2).cast("int").alias("quality"))
    got = cotrain.classify(docs, marks.unionByName(marks), tables[2])
    assert got.count() == docs.count() and got.where("score IS NULL OR score < 0 OR score > 1").count() == 0


def test_cotraining_sums_equal_one_pass(spark, docs):
    """The sums over all tasks are those of one array of all unlabelled rows."""
    rng = np.random.default_rng(2)
    seen = cotrain.features(docs, spark.createDataFrame([(i, i % 2) for i in range(40)], "doc_id long, quality int"), spark.createDataFrame([], "url string"))
    model = cotrain.CoTrained([rng.normal(size=(80, 139)), rng.normal(size=(80, 99))], rng.integers(0, 2, 80))
    whole = cotrain.unpacked(seen.where("label IS NULL").select("x", "m").toArrow().combine_chunks())
    assert np.allclose(cotrain._total(seen.repartition(5), model, model.models), model.sums(model.models, whole))


def test_decontamination(spark, docs):
    items = [(1, " ".join(f"W{i}" for i in range(50, 70))), (2, "a b c d"), (2, "a b c d"), (3, None), (4, "..."), (5, "two words"), (None, "one")]
    bench = spark.createDataFrame(items, "item_id long, text string")
    wins = defaultdict(set)
    word = re.compile("[^\x00-\x2f\x3a-\x60\x7b-\x7f]+")
    for i, t in items:
        w = word.findall(lower(t))
        n = min(10, len(w))
        for k in range(len(w) - n + 1 if w else 0):
            wins[tuple(w[k : k + n])].add(i)
    for block in (decontam.BLOCK_BYTES, 20):
        got = {r.doc_id: r for r in decontam.report(decontam.matches(docs, bench, block_bytes=block)).collect()}
        for r in docs.where("doc_id IS NOT NULL").collect():
            w, hit, ids = word.findall(lower(r.text)), set(), set()
            for n in {len(k) for k in wins}:
                for k in range(len(w) - n + 1):
                    if tuple(w[k : k + n]) in wins:
                        hit |= set(range(k, k + n))
                        ids |= wins[tuple(w[k : k + n])] - {None}
            x = got[r.doc_id]
            assert (x.n_words, x.n_hit, x.n_items, x.items_sha256, x.contaminated) == (len(w), len(hit), len(ids), decontam.digest(ids), bool(hit))
    assert decontam.report(decontam.matches(docs, bench.limit(0))).where("contaminated").count() == 0


def test_near_duplicates(docs):
    sets = {}
    for r in docs.where("doc_id IS NOT NULL").collect():
        w = re.findall(r"[^\x20\x09-\x0D]+", lower(r.text))
        sets[r.doc_id] = {tuple(w[i : i + 4]) for i in range(max(1, len(w) - 3))} if w else set()
    label = {k: k for k in sets}
    for _ in range(5):
        for a in sets:
            for b in sets:
                if a < b and sets[a] and sets[b] and 100 * len(sets[a] & sets[b]) >= 80 * len(sets[a] | sets[b]):
                    label[a] = label[b] = min(label[a], label[b])
    got = {r.doc_id: r for r in minhash.near_duplicates(docs, k=4).collect()}
    assert got[None].component_id is None and got[None].kept
    for k in sets:
        assert (got[k].n_shingles, got[k].component_id, got[k].kept) == (len(sets[k]), label[k], label[k] == k)
    assert minhash.near_duplicates(docs.limit(0)).count() == 0


def edited(words, n, rng):
    """The words with n of them, well apart, put out for new ones."""
    out = list(words)
    for i in rng.sample(range(len(out) // 6), n):
        out[6 * i] = f"e{rng.getrandbits(60)}"
    return out


def true_components(rows, percent=80):
    """Brute force: the smallest id that each id reaches over pairs of sets of five words."""
    sets = {k: {tuple(w[i : i + 5]) for i in range(len(w) - 4)} for k, w in rows}
    label = {k: k for k in sets}
    for a in sets:
        for b in sets:
            if a < b and label[a] != label[b] and 100 * len(sets[a] & sets[b]) >= percent * len(sets[a] | sets[b]):
                low, high = sorted((label[a], label[b]))
                label = {k: low if v == high else v for k, v in label.items()}
    return label


def near_components(spark, rows):
    docs = spark.createDataFrame([(k, " ".join(w)) for k, w in rows], "doc_id long, text string")
    return {r.doc_id: r.component_id for r in minhash.near_duplicates(docs).collect()}


def test_copies_of_an_original_with_a_middle_id(spark):
    """Copies that only reach the similarity with their original are one component, whatever its id."""
    rng = random.Random(11)
    base = [f"w{rng.getrandbits(60)}" for _ in range(600)]
    rows = [(i, base if i == 51 else edited(base, 11, rng)) for i in range(1, 102)]
    assert set(true_components(rows).values()) == {1}
    assert near_components(spark, rows) == true_components(rows)


def test_pairs_in_crowded_buckets(spark):
    """Pairs near the similarity are found where other texts with smaller ids head all buckets that they share."""
    rng = random.Random(12)
    passage = [f"p{rng.getrandbits(30)}" for _ in range(300)]
    rows = [(i, edited(passage, 8, rng)) for i in range(1, 60)] + [(0, edited(passage, 3, rng))]
    for i in range(100, 200):
        at = rng.getrandbits(30)
        for k in (i, i + 100):  # new words at the same six places
            spots = set(random.Random(at).sample(range(50), 6))
            rows.append((k, [f"e{rng.getrandbits(60)}" if j % 6 == 0 and j // 6 in spots else w for j, w in enumerate(passage)]))
    assert near_components(spark, rows) == true_components(rows)


def test_densified_bands_find_similar_sets():
    """Pairs of similarity near 0.8 meet in some band, for small and large sets."""
    rng = np.random.default_rng(4)
    for n in (9, 27, 90, 450):
        missed = 0
        for _ in range(150):
            common, own = rng.integers(0, 2**63, 8 * n // 9, dtype=np.uint64), rng.integers(0, 2**63, (2, n // 9), dtype=np.uint64)
            keys = []
            for o in own:
                values = np.sort(minhash.mix(np.concatenate([common, o])))
                keys.append(minhash.band_keys(minhash.signatures(np.zeros(len(values), np.int64), values, 1, 240), 40, 6)[0])
            missed += not (keys[0] == keys[1]).any()
        assert missed <= 1


@pytest.mark.parametrize("most", [BROADCAST_ROWS, 0])
def test_components(spark, monkeypatch, most):
    """Alike whether minima are broadcast or shuffled."""
    monkeypatch.setattr("strandgraph.llm.common.BROADCAST_ROWS", most)
    edges = [(1, 2), (2, 3), (3, 4), (4, 5), (9, 8), (8, 7), (20, 21)]
    got, most_ids = components.connected_components(spark.createDataFrame(edges, "a long, b long"))
    assert {r.id: r.component for r in got.collect()} == {1: 1, 2: 1, 3: 1, 4: 1, 5: 1, 7: 7, 8: 7, 9: 7, 20: 20, 21: 20}
    assert got.count() <= most_ids
    assert components.connected_components(spark.createDataFrame([], "a long, b long"))[0].count() == 0


def test_pfair(spark, docs):
    parts = {"a": 48, "b": 30, "c": 13, None: 6}
    order = mixing.schedule(parts, 97)
    given = Counter()
    for t, n in enumerate(order, 1):
        given[n] += 1
        assert all(abs(given[k] - t * parts[k] / 97) < 1 for k in parts)
    many = docs.crossJoin(spark.range(9).withColumnRenamed("id", "copy"))
    got = mixing.mix(many, {"a": 3, "b": 1}, block=4).collect()
    assert sorted(r.mix_position for r in got) == list(range(many.count()))
    assert [r.slot for r in sorted(got, key=lambda r: r.mix_position)] == sorted(r.slot for r in got)
    assert all(r.release <= r.slot < r.deadline for r in got)
    assert mixing.mix(docs.limit(0)).count() == 0


def by_hand(weights, slots):
    """Every slot by its definition: of the released blocks, the one with the earliest deadline (then the heavier source)."""
    total, given, out = sum(weights.values()), Counter(), []
    names = list(weights)
    for t in range(slots):
        free = [(-(-(given[n] + 1) * total // weights[n]), -weights[n], names.index(n), n) for n in names if given[n] * total // weights[n] <= t]
        out.append(min(free)[3])
        given[out[-1]] += 1
        assert all(abs(total * given[n] - (t + 1) * weights[n]) < total for n in names)
    return out


@pytest.mark.parametrize("weights", [{"a": 5, "b": 3, "c": 1}, {"a": 90, **{f"s{i}": 1 for i in range(10)}}, {"a": 1000, "b": 1}])
def test_pfair_equals_the_definition(weights):
    """10,000 slots of the given weights, each prefix within one block of them."""
    assert mixing.schedule(weights, 10_000) == by_hand(weights, 10_000)


def test_pfair_keeps_to_the_given_weights(spark):
    """Over many slots every source stays less than one block from its exact weight, and in its exact window."""
    weights = {"a": 0.97, "b": 0.01, "c": 0.01, "d": 0.01}
    rows = spark.range(4000).selectExpr("id AS doc_id", "CASE WHEN id < 3880 THEN 'a' WHEN id < 3920 THEN 'b' WHEN id < 3960 THEN 'c' ELSE 'd' END AS source")
    got = sorted(mixing.mix(rows, weights, block=1).collect(), key=lambda r: r.slot)
    assert [r.slot for r in got] == [r.mix_position for r in got] == list(range(4000))
    given = Counter()
    for r in got[:3900]:
        given[r.source] += 1
        part = round(100 * weights[r.source])
        assert (r.release, r.deadline) == (r.block * 100 // part, -(-(r.block + 1) * 100 // part)) and r.release <= r.slot < r.deadline
        assert all(abs(100 * given[n] - (r.slot + 1) * round(100 * w)) < 100 for n, w in weights.items())


def test_plan_gives_every_block_once():
    """Odd weights, a weight of 0 and sources that run out."""
    blocks = {"a": 70, "b": 400, None: 9, "z": 5}
    rows = list(mixing.plan(blocks, {"a": 3**0.5, "b": 17**0.5, None: 1, "z": 0}, {"a": 3, "z": 1}, 4))
    assert [r[2] for r in rows] == list(range(484)) and {r[0] for r in rows[-5:]} == {"z"}
    assert {r[:2] for r in rows} == {(n, i) for n, b in blocks.items() for i in range(b)}
    assert all(release <= slot < deadline for _, _, slot, release, deadline, _ in rows)
    size = [1 if r[:2] == ("a", 69) else 3 if r[:2] == ("z", 4) else 4 for r in rows]
    assert [r[5] for r in rows] == [sum(size[:i]) for i in range(484)]


def test_pipeline(spark, docs, tmp_path):
    import corpus_pipeline

    sf = "/root/testdata/sf0.001"
    whole = spark.read.parquet(f"{sf}/documents.parquet")
    seen = whole
    for name, stage in corpus_pipeline.STAGES[:-1]:
        before = seen
        stage(spark, seen, sf).write.parquet(str(tmp_path / name))
        seen = spark.read.parquet(str(tmp_path / name))
        assert seen.columns == whole.columns
        assert seen.exceptAll(before).count() == 0
        if name == "mixing":
            assert seen.count() == before.count()
    out = corpus_pipeline.STAGES[-1][1](spark, seen, sf).collect()
    assert len(out) == seen.count() and len({r.start for r in out}) == len(out)
    assert sorted(r.doc_id for r in out) != [r.doc_id for r in sorted(out, key=lambda r: r.start)]
    for name, stage in corpus_pipeline.STAGES:
        assert stage(spark, docs, sf).count() <= docs.count()
