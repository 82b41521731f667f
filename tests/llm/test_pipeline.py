"""The pipeline's stages, each judged on its own input."""

import hashlib
import random

import public_tokenizers
from tokenizers import Tokenizer

import corpus_pipeline
from screenloom.llm import common, nearcopies


def test_stages(spark):
    folder = "/root/testdata/sf0.001"
    docs = spark.read.parquet(f"{folder}/documents.parquet").cache()
    columns, items = docs.columns, [r.text for r in spark.read.parquet(f"{folder}/benchmark.parquet").collect()]
    for name, stage in corpus_pipeline.STAGES[:-1]:
        kept = stage(spark, docs, folder).cache()
        assert kept.columns == columns and 0.8 * docs.count() <= kept.count() <= docs.count()
        if name == "near copies":
            assert kept.count() == kept.select("text").distinct().count()
        if name == "benchmark leaks":
            gone = {r.text for r in docs.collect()} - {r.text for r in kept.collect()}
            assert gone == {r.text for r in docs.collect() if any(i in r.text for i in items)}
        if name == "secrets":
            assert kept.count() == docs.count() and kept.where("text rlike 'AKIA[A-Z0-9]{14,}|[0-9a-f]{16,}'").isEmpty()
        docs = kept
    tokenizer = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    got = {r.doc_id: (r.n_tokens, r.decoded_sha256) for r in corpus_pipeline.STAGES[-1][1](spark, docs, folder).collect()}
    assert got == {r.doc_id: (len(tokenizer.encode(r.text, add_special_tokens=False).ids), hashlib.sha256(r.text.encode()).hexdigest()) for r in docs.collect()}


def shingle_set(text, n=5):
    words = text.lower().split()
    return {tuple(words[i : i + n]) for i in range(max(1, len(words) - n + 1))} if words else set()


def test_near_copies(spark):
    """Edited copies on both sides of 0.8 against all pairs, repeated rows and null ids."""
    rng = random.Random(11)
    vocabulary = [f"w{i}" for i in range(400)]
    rows, columns = [], "doc_id long, text string, source string"
    for _ in range(25):
        words = rng.choices(vocabulary, k=rng.randint(40, 160))
        rows.append((len(rows), " ".join(words), "s"))
        for changes in (0, 1, 1, 2, 3, 4, 6):
            edited = list(words)
            for at in rng.sample(range(len(edited)), changes):
                edited[at] = rng.choice(["other", edited[at] + " more", ""])
            rows.append((len(rows), " ".join(edited), "s"))
    rows += [rows[0], rows[0], (None, "no id at all here", "s"), (None, "no id at all here", "s"), (None, "another text of no id", "s"), (900, "", "s"), (901, " ", "s"), (902, "", "s")]
    sets = [shingle_set(r[1]) for r in rows]
    label = list(range(len(rows)))
    for i in range(len(rows)):
        for j in range(i):
            if rows[i][1] == rows[j][1] or sets[i] and 5 * len(sets[i] & sets[j]) >= 4 * len(sets[i] | sets[j]):
                label = [label[j] if x == label[i] else x for x in label]
    best = {}
    for r, x in zip(rows, label):
        row = (r[0] is None, r[0] or 0, r[1])
        best[x] = min(best.get(x, row), row)
    expected = sorted(best.values())
    rng.shuffle(rows)
    kept = corpus_pipeline.near_copies(spark, spark.createDataFrame(rows, columns), "").collect()
    assert sorted((r.doc_id is None, r.doc_id or 0, r.text) for r in kept) == expected


def test_near_copies_in_one_band(spark):
    """Forty pairs of copies that all share one band are forty groups, with one centre a round at first and then more."""
    rng = random.Random(4)
    rows = []
    for k in range(40):
        words = [f"{k}x{rng.randrange(10**6)}" for _ in range(100)]
        rows += [(2 * k, " ".join(words)), (2 * k + 1, " ".join([*words[:-1], "end"]))]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    points = nearcopies.sketches(docs).selectExpr("node", "doc_id as rep", "array(77L) as bands")
    found = nearcopies.groups(docs, common.table(points, "points")).collect()
    assert len(found) == 80 and len({r.group for r in found}) == 40
    by = {}
    for r in found:
        by.setdefault(r.group, set()).add(r.rep // 2)
    assert all(len(x) == 1 for x in by.values())


def test_recall(spark):
    """Pairs of a similarity just over 0.8: at least 0.9 of them come out as one group, measured over the whole stage."""
    rng = random.Random(8)
    vocabulary = [f"w{i}" for i in range(5000)]
    rows, pairs = [], 0
    for k in range(300):
        words = rng.choices(vocabulary, k=120)
        edited = list(words)
        for at in (20, 90):
            edited[at] = "changed"
        a, b = shingle_set(" ".join(words)), shingle_set(" ".join(edited))
        if len(a & b) >= 0.8 * len(a | b):
            pairs += 1
            rows += [(2 * k, " ".join(words)), (2 * k + 1, " ".join(edited))]
    kept = corpus_pipeline.near_copies(spark, spark.createDataFrame(rows, "doc_id long, text string"), "").count()
    assert pairs > 200 and 2 * pairs - kept >= 0.9 * pairs


def test_tables_go(spark):
    """After a run the shared folder holds what the result reads, and no earlier stage's table."""
    before = len(common.WRITTEN)
    made = corpus_pipeline.run(spark, "/root/testdata/sf0.001")
    kept = {x.rsplit("/", 1)[1].rsplit("-", 1)[0] for x in common.WRITTEN[before:]}
    assert kept == {"secrets"} and made.count() > 0


def test_edges(spark, tmp_path):
    """Every stage on nulls in any column, empty and repeated rows, clashing columns, no rows and no benchmark."""
    columns = "doc_id long, text string, lang string, source string, n_chars long, score double, lang_pred string, row string, key long, whole int, language string, gone int, stays int"
    rest = (7.5, "keepme", "r", 3, 4, "l", 5, 6)
    words = "the house of the tree is by the river and the light of the stone is over the water".split()
    rng = random.Random(3)
    rows = [(i, " ".join(rng.choices(words, k=40)), "en", "s", 9, *rest) for i in range(30)]
    rows += [rows[0], rows[0], (None, rows[1][1], None, None, None, *rest), (None, "only here the house is of stone", "en", "s", 3, *rest), (None, None, None, None, None, *[None] * 8), (50, "", "en", "s", 0, *rest), (51, "  ", "en", "s", 2, *rest)]
    spark.createDataFrame([(1, "no document has this sentence about anything"), (None, None)], "item_id long, text string").write.parquet(str(tmp_path / "benchmark.parquet"))
    (tmp_path / "none").mkdir()
    spark.createDataFrame([], "item_id long, text string").write.parquet(str(tmp_path / "none" / "benchmark.parquet"))
    docs = spark.createDataFrame(rows, columns)
    for name, stage in corpus_pipeline.STAGES:
        assert stage(spark, docs.limit(0), str(tmp_path)).count() == 0
        for folder in (tmp_path, tmp_path / "none"):
            kept = stage(spark, docs, str(folder))
            if name == "token ids":
                assert kept.count() == len(rows)
                continue
            assert kept.columns == docs.columns
            got = kept.collect()
            assert {(r.score, r.lang_pred, r.row, r.key, r.whole, r.language, r.gone, r.stays) for r in got} - {(None,) * 8} == {rest}
            gone = {"language": {"", "  ", None}}.get(name, set())
            assert {r.text for r in got} == {r[1] for r in rows} - gone
            assert len(got) == (len({r[1] for r in rows}) if name == "near copies" else len([r for r in rows if r[1] not in gone]))


def test_near_copies_take_linked_fingerprints(spark):
    """Copies that share no band are found by operator 2's links between fingerprints."""
    rng = random.Random(5)
    words = [f"w{rng.randrange(5000)}" for _ in range(400)]
    rows = [(1, " ".join(words)), (2, " ".join([*words[:-1], "end"])), (3, " ".join(f"other{i}" for i in range(50)))]
    own = nearcopies.sketches(spark.createDataFrame(rows, "doc_id long, text string"))
    points = common.table(own.selectExpr("node", "doc_id as rep", "fp", "array(doc_id) as bands"), "points")
    found = nearcopies.groups(spark.createDataFrame(rows, "doc_id long, text string"), points, prints=nearcopies.near_prints(points)).collect()
    group = {r.rep: r.group for r in found}
    assert group[1] == group[2] != group[3]


def test_rare_shingles_find_every_pair(spark):
    """The pairs by rare shingles, checked, are those of a comparison of all pairs: edits at random places, of texts of unequal lengths."""
    rng = random.Random(11)
    texts = []
    for _ in range(6):
        base = [f"w{rng.randrange(10**6)}" for _ in range(rng.randrange(30, 120))]
        for _ in range(25):
            words = base[: len(base) - rng.randrange(12)]
            for _ in range(rng.randrange(5)):
                words[rng.randrange(len(words))] = f"x{rng.randrange(10**6)}"
            texts.append(" ".join(words))
    texts = ["one two", "one two three four five", *dict.fromkeys(texts)]
    sets = common.table(nearcopies.grams(spark.createDataFrame(list(enumerate(texts)), "node long, text string")), "grams")
    pairs = nearcopies.by_rare_shingles(sets, 0.8)
    found = {tuple(sorted((r.node, r.centre))) for r in nearcopies.alike(pairs, sets, 0.8).collect()}
    own = [shingle_set(t) for t in texts]
    wanted = {(i, j) for j in range(len(own)) for i in range(j) if len(own[i] & own[j]) >= 0.8 * len(own[i] | own[j])}
    assert found == wanted and len(wanted) > 100
    assert pairs.count() == pairs.distinct().count() < len(texts) * (len(texts) - 1) // 6


def test_unlike_texts_of_a_band_are_not_all_compared(spark, monkeypatch):
    """A band of texts that are edited too far to be alike: a few comparisons a text, not one with each other text; a pair of copies among them is found."""
    rng = random.Random(5)
    base = [f"w{i}" for i in range(100)]
    texts = []
    for i in range(240):
        words = list(base)
        for at in rng.sample(range(100), 8):
            words[at] = f"x{i}y{at}"
        texts.append(" ".join(words))
    texts.append(texts[77] + " again")
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    points = common.table(nearcopies.sketches(docs).selectExpr("node", "doc_id as rep", "array(77L) as bands"), "points")
    compared, alike = [], nearcopies.alike
    monkeypatch.setattr(nearcopies, "alike", lambda pairs, sets, least: compared.append(pairs.count()) or alike(pairs, sets, least))
    found = nearcopies.groups(docs, points).collect()
    together = [r.rep for r in found if sum(o.group == r.group for o in found) > 1]
    assert sorted(together) == [77, 240] and sum(compared) < 6 * len(texts)
