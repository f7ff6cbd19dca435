"""Every operator against a brute-force version, over given documents and the odd cases."""

import collections
import hashlib
import re
import textwrap
import tracemalloc
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from veritally.llm import (
    decontamination, licenses, mixing, ngram_join, quality, queries, sharding, suffix_dedup, token_shards, toxicity, warc_bundles)
from veritally.llm.common import prepare, table
from veritally.llm.queries import word_pieces
from veritally.session import written

SF_DIR = "/root/testdata/sf0.001"
LONG = " ".join(f"w{i % 977}x{i % 13}" for i in range(40_000))
TWICE = "Some copied page about rivers and hills. " * 12
ODD = [
    (None, "a text without an id, met by nothing else in this corpus at all", "en", None, 5),
    (90001, None, None, None, None),
    (90002, "", "en", "src0", 0),
    (90003, LONG, "en", "srcX", len(LONG)),
    (90004, TWICE, "en", "src1", 1), (90004, TWICE, "en", "src1", 1), (90005, TWICE, "fr", "src2", 1),
    (90006, "\0İstanbul ΣΑΣ <|endoftext|> ǅ x́ \x1c tail's \t\v end", "en", "src1", 1),
    (90007, "one", "en", "src3", 3),
]
#: Names the operators use inside.
CLASHING = ["size", "key", "row", "target", "copies", "shard", "n", "term", "pos", "word", "v", "bands", "path", "id", "w",
            "parts", "u", "bin", "slot", "source_size", "kept", "copy", "item", "toxic", "score", "digest", "__w", "_bad"]
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"


@pytest.fixture(scope="module")
def docs(spark, tmp_path_factory):
    given = table(spark, SF_DIR, "documents").unionByName(spark.createDataFrame(ODD, SCHEMA))
    path = str(tmp_path_factory.mktemp("docs") / "table")
    given.withColumns({c: F.lit("clash") for c in CLASHING}).write.parquet(path)
    return spark.read.parquet(path)


@pytest.fixture(scope="module")
def rows(docs):
    return [(r.doc_id, r.text, r.source) for r in docs.select("doc_id", "text", "source").collect()]


@pytest.fixture(scope="module")
def empty(docs):
    return docs.where("false")


@pytest.fixture(scope="module")
def labels(spark):
    return table(spark, SF_DIR, "labels")


def words(text):
    return [w for w in re.split(r"[\x20\x09-\x0D]+", text or "") if w]


# ---------------------------------------------------------------- 1 quality

def test_quality_counts_and_ratio(spark, docs, rows, labels):
    import xxhash

    rules = quality.QualityRules(buckets=512)
    got = collections.Counter(tuple(r) for r in quality.score_documents(docs, labels, rules).selectExpr(
        "doc_id", "__quality.n_words", "__quality.word_chars", "__quality.n_symbols", "__quality.n_dup_lines",
        "__quality.n_repeat_words", "round(__quality.ratio, 9)", "__quality.kept").collect())
    trusted = {r.doc_id for r in labels.where("quality = 1").collect()}

    def cells(w):
        h = lambda s, seed=42: xxhash.xxh64_intdigest(s.encode(), seed)
        signed = lambda x: x - (1 << 64) if x >> 63 else x
        return [signed(h(a)) % 512 for a in w] + [signed(h(b, h(a))) % 512 for a, b in zip(w, w[1:])]

    raw, target = np.zeros(512), np.zeros(512)
    for doc_id, text, _ in rows:
        for c in cells(words(text)):
            raw[c] += 1
            target[c] += doc_id in trusted
    ratios = np.log((target + 1) / (target.sum() + 512)) - np.log((raw + 1) / (raw.sum() + 512))
    want = collections.Counter()
    for doc_id, text, _ in rows:
        w, t = words(text), text or ""
        seen = collections.Counter(zip(w, w[1:], w[2:]))
        covered = {i + k for i in range(len(w) - 2) if seen[tuple(w[i:i + 3])] > 1 for k in range(3)}
        lines = [x for x in t.split("\n") if words(x)]
        ratio = float(np.mean(ratios[cells(w)])) if w else 0.0
        failed = len(w) < 50 or 100 * len(covered) > 50 * len(w)
        want[doc_id, len(w), sum(map(len, w)), sum(c in "#*$%&|<>" for c in t), len(lines) - len(set(lines)), len(covered),
             round(ratio, 9), not failed and ratio >= rules.least_ratio] += 1
    close = lambda c: collections.Counter((*k[:6], round(k[6], 6), k[7]) for k in c.elements())
    assert close(got) == close(want)
    kept = quality.keep_good(docs, labels, rules)
    assert kept.columns == docs.columns and kept.count() == sum(n for k, n in want.items() if k[-1])


def test_quality_of_nothing(empty, docs, labels):
    assert quality.keep_good(empty, labels).count() == 0
    assert {r.ratio for r in quality.score_documents(docs.limit(5), labels.where("false")).select("__quality.ratio").collect()} == {0.0}


def test_quality_follows_the_labels_of_each_language(spark):
    given, known = table(spark, "/root/testdata/sf0.1", "documents"), table(spark, "/root/testdata/sf0.1", "labels")
    scored = quality.score_documents(given, known).where("NOT __quality.base_failed").join(
        known.select("doc_id", F.col("quality").alias("label")), "doc_id")
    seen = scored.groupBy("lang", "label").agg(F.count("*").alias("n"), F.sum(F.expr("int(__quality.kept)")).alias("kept")).collect()
    assert {r.label for r in seen} == {0, 1} and len({r.lang for r in seen}) > 1
    for r in seen:
        assert r.kept <= 0.02 * r.n if r.label == 0 else r.kept >= 0.98 * r.n, r
    # Documents nobody labelled are mostly like the trusted ones, and are not held against them.
    rest = quality.score_documents(given, known).where("NOT __quality.base_failed").join(known, "doc_id", "left_anti")
    assert rest.where("__quality.kept").count() > 0.85 * rest.count()


def test_quality_trusts_every_good_document(spark):
    given = spark.range(20_000).select(F.col("id").alias("doc_id"), F.lit("good").alias("text"))
    known = given.select("doc_id", F.lit(1).alias("quality"))
    prepare(spark)
    for how in (quality.QualityRules(buckets=8), quality.QualityRules(buckets=8, broadcast_ids=0)):
        counts = quality.cell_counts(given, quality.trusted_ids(known), how).collect()
        assert [(r.n_target, r.n_raw) for r in counts] == [(20_000, 20_000)]


def test_ratios_reach_the_tasks_in_few_rows(spark):
    """The table that is broadcast has a row per 1,024 cells, with every cell in its place."""
    few = spark.range(0, 5000, 3).selectExpr("CAST(id AS INT) AS cell", "id / 7 AS ratio", "-id / 9 AS left_out")
    got = sorted(quality.in_rows(few, 5000).collect())
    assert [(r.part, len(r.ratios), len(r.left_outs)) for r in got] == [(p, n, n) for p, n in enumerate([1024] * 4 + [904])]
    assert [x for r in got for x in r.ratios] == [i / 7 if i % 3 == 0 else None for i in range(5000)]
    assert [x for r in got for x in r.left_outs] == [-i / 9 if i % 3 == 0 else None for i in range(5000)]


# ---------------------------------------------------------------- 2 mixing

def test_mix_meets_targets(spark, docs, empty):
    sized = mixing.with_size(docs, "n_w").select("doc_id", "source", "n_w")
    mixed = mixing.mix_documents(sized, size="n_w").collect()
    by = collections.defaultdict(list)
    for r in mixed:
        by[r.source].append(r)
    total = {s: sum(r.n_w for r in v) for s, v in by.items()}
    order = sorted(total, key=lambda s: (s is None, (s or "").encode()))
    weight, level, capped = {s: (5, 2, 1)[i % 3] for i, s in enumerate(order)}, 0, set()
    while True:
        rest = sum(total.values()) - sum(3 * total[s] for s in capped)
        level = rest / sum(weight[s] for s in order if s not in capped)
        more = {s for s in order if s not in capped and weight[s] * level > 3 * total[s]}
        if not more:
            break
        capped |= more
    for s in order:
        target = 3 * total[s] if s in capped else weight[s] * level
        assert all(r.target == pytest.approx(target) and r.source_size == total[s] for r in by[s])
        taken = sum(r.n_w * r.copies for r in by[s])
        sizes = [r.n_w for r in by[s] if r.n_w]
        assert abs(taken - target) <= max(max(sizes, default=0) / 2 + 1, 0.05 * target), s
    assert len(mixed) == docs.count() and {r.copies for r in mixed} <= {0, 1, 2, 3}
    again = mixing.mix_documents(sized, size="n_w")
    key = lambda r: (r.doc_id or -1, r.n_w, r.copies)
    assert sorted(map(key, again.collect())) == sorted(map(key, mixed))
    taken = mixing.mixed_rows(docs)
    assert taken.columns == docs.columns and taken.count() == sum(r.copies for r in mixed)
    assert mixing.mixed_rows(empty).count() == 0


# ---------------------------------------------------------------- 3 toxicity

def test_toxicity_learns_from_its_folds_only(docs, labels, empty):
    many = table(docs.sparkSession, "/root/testdata/sf0.01", "documents")
    known = table(docs.sparkSession, "/root/testdata/sf0.01", "labels")
    model = toxicity.fit(many, known)
    flipped = known.withColumn("toxic", F.when(toxicity.held_out("doc_id"), 1 - F.col("toxic")).otherwise(F.col("toxic")))
    assert toxicity.fit(many, flipped) == model
    scored = {r.doc_id: r for r in toxicity.score_documents(many, model).collect()}
    hits = [(scored[r.doc_id].score >= 0.5, r.toxic, zlib.crc32(str(r.doc_id).encode()) % 3 == 1) for r in known.collect()]
    assert all(s is not None and 0 <= s.score <= 1 for s in scored.values())
    assert sum(a == bool(b) for a, b, _ in hits) / len(hits) > 0.9
    odd = toxicity.score_documents(docs, model).where("doc_id IN (90001, 90002)").collect()
    assert [(r.score, r.worst_start) for r in odd] == [(0.0, None)] * 2
    place = toxicity.offending_sentences(many, model).first()
    text = many.where(many.doc_id == place.doc_id).first().text
    assert text[place.start:place.end] == place.sentence and place.score >= 0.5
    assert toxicity.score_documents(empty, model).count() == 0
    assert toxicity.fit(empty, known) == toxicity.fit(many, known.where("false")) == toxicity.Model(-12.0, {})


def test_noisy_or_of_sentences():
    model = toxicity.Model(-2.0, {"bad": 3.0, "^ugly": 1.0})
    z = [x[2] for x in toxicity._rated("a bad day. uglyness bad! fine", model)]
    assert z == [1.0, 2.0, -2.0]


# ---------------------------------------------------------------- 4 sharding

def test_shards_are_even_and_copies_stay_together(docs, rows, empty):
    got = sharding.shard_documents(docs).collect()
    assert len(got) == len(rows)
    loads, slots = collections.Counter(), collections.defaultdict(list)
    for r in got:
        loads[r.shard] += r.size
        slots[r.shard].append(r.slot)
    largest = max(r.size for r in got)
    assert max(loads.values()) - min(loads[s] for s in range(8)) <= largest
    assert all(sorted(v) == list(range(len(v))) for v in slots.values())
    want = collections.Counter((d, len((t or "").encode()) + 1, zlib.crc32((t or "").encode())) for d, t, _ in rows)
    assert collections.Counter((r.doc_id, r.size, r.text_crc32) for r in got) == want
    by_text = collections.defaultdict(set)
    for r in got:
        by_text[r.text_crc32, r.size].add(r.shard)
    assert all(len(v) == 1 for v in by_text.values())
    assert sharding.shard_documents(empty).count() == 0


def test_a_text_larger_than_a_shard_is_split_evenly(spark):
    many = spark.createDataFrame([(i, "same text") for i in range(400)] + [(i, f"other {i:04d}") for i in range(400, 1000)],
                                 "doc_id long, text string")
    got = sharding.shard_documents(many).groupBy("shard").agg(F.sum("size").alias("s")).collect()
    sizes = [r.s for r in got]
    assert len(sizes) == 8 and max(sizes) - min(sizes) <= 12


def test_ids_that_repeat_do_not_overload_a_shard(spark):
    given = [(None, "the same words")] * 2000 + [(7, f"text {i}") for i in range(1000)] + [(100 + i, f"other text {i}" + " x" * (i % 9)) for i in range(2000)]
    docs = spark.createDataFrame(given, "doc_id long, text string").repartition(7)
    prepare(spark)
    placed = sharding.shard_documents(docs)
    sums = {r.shard: r.bytes for r in placed.groupBy("shard").agg(F.sum("size").alias("bytes")).collect()}
    assert len(sums) == 8 and max(sums.values()) - min(sums.values()) <= max(len(t) + 1 for _, t in given)
    slots = collections.defaultdict(list)
    for r in placed.select("shard", "slot").collect():
        slots[r.shard].append(r.slot)
    assert sum(map(len, slots.values())) == 5000 and all(sorted(x) == list(range(len(x))) for x in slots.values())


def test_propagation_cuts_fewer_links(spark):
    prepare(spark)
    docs = spark.createDataFrame([(i, f"text {i % 400}") for i in range(3000)], "doc_id long, text string")
    how = sharding.Shards()
    nodes = sharding.spread(written(sharding.sized(docs)))
    before = sharding.cut_links(nodes.selectExpr("key", f"CAST(floor(u * {how.parcels}) % {how.count} AS INT) AS shard")).first()
    after = sharding.cut_links(sharding.shard_documents(docs, how).selectExpr("text_crc32 AS key", "shard")).first()
    assert before.links == after.links == sum(n * (n - 1) // 2 for n in collections.Counter(i % 400 for i in range(3000)).values())
    assert after.cut < 0.2 * before.cut


# ---------------------------------------------------------------- 5 WARC

def test_bundles_round_trip(spark, tmp_path):
    same = "x" * 999 + "é"
    pages = [(1, "http://a/1", same), (7, "http://a/7", same), (7, "http://a/7", same), (3, None, None), (4, "http://a b/\n", ""),
             (None, "http://n", same), (5, "u", "y" * 999), (6, "u", "y" * 999), (8, "u", "\r\n\r\nWARC/1.1\r\n" + "z" * 500_000)]
    given = spark.createDataFrame(pages, "page_id long, url string, html string").withColumn("payload_digest", F.lit(1))
    prepare(spark)
    how = warc_bundles.Bundles(frame_bytes=2000, bundle_bytes=3000)
    index = warc_bundles.write_bundles(given, str(tmp_path / "warc"), how)
    got = warc_bundles.read_bundles(index).collect()
    sha = lambda t: hashlib.sha1((t or "").encode()).hexdigest()
    want = collections.Counter()
    for page_id, _, html in pages:
        revisit = html == same and page_id != 7
        want[page_id, len((html or "").encode()), sha(html), "revisit" if revisit else "response", 7 if revisit else None] += 1
    assert collections.Counter(tuple(r[:5]) for r in got) == want
    for r in index.where("page_id IN (5, 8)").collect():
        bundle = warc_bundles.Reader(r.path)
        found = bundle.record(r.frame, r.offset)
        assert found["page_id"] == r.page_id and found["payload"].decode() == dict((p[0], p[2]) for p in pages)[r.page_id]
        bundle.close()
    assert warc_bundles.archive(given.where("false")).count() == 0


# ---------------------------------------------------------------- 6 Jaccard join

def links_of(rows):
    sets = []
    for _, text, _ in rows:
        w = (text or "").encode().split()
        sets.append({tuple(w[i:i + 5]) for i in range(len(w) - 4)} or ({tuple(w)} if w else set()))
    found = collections.defaultdict(set)
    for a in range(len(rows)):
        for b in range(a):
            both = len(sets[a] & sets[b]) if rows[a][0] is not None and rows[b][0] is not None else 0
            if both and 5 * both >= 4 * len(sets[a] | sets[b]):
                found[a].add(b)
                found[b].add(a)
    return found


@pytest.mark.parametrize("how", [ngram_join.JaccardJoin(), ngram_join.JaccardJoin(block_texts=3)])
def test_join_finds_every_link(docs, rows, how):
    found, root = links_of(rows), list(range(len(rows)))
    for _ in range(len(rows)):
        new = [min([root[a], *(root[b] for b in found[a])], key=lambda x: (rows[x][0] is None, rows[x][0] or 0)) for a in range(len(rows))]
        if new == root:
            break
        root = new
    want = collections.Counter((rows[a][0], rows[root[a]][0], len(found[a])) for a in range(len(rows)))
    assert collections.Counter(tuple(r) for r in ngram_join.near_duplicates(docs, how).collect()) == want


def test_one_of_each_class_stays(docs, empty):
    kept = ngram_join.keep_one(docs)
    classes = ngram_join.near_duplicates(docs).where("doc_id IS NOT NULL").select("class_id").distinct().count()
    assert kept.columns == docs.columns and kept.where("doc_id IS NOT NULL").count() == classes
    assert kept.where("doc_id IS NULL").count() == 1 and ngram_join.keep_one(empty).count() == 0


@pytest.mark.parametrize("turn", [1, -1])
def test_one_id_with_two_texts(spark, turn):
    text = lambda name, n=60: " ".join(f"{name}{i}" for i in range(n))
    given = [(1, text("a")), (1, text("b")), (2, text("a", 59)), (3, text("b", 59)), (4, text("c")), (5, text("c")), (5, text("d")),
             (6, text("e")), (6, text("e", 59)), (7, text("f")), (7, "\t" + text("f") + "\n")]
    prepare(spark)
    docs = spark.createDataFrame(given[::turn], "doc_id long, text string").coalesce(1)
    got = collections.Counter(tuple(r) for r in ngram_join.near_duplicates(docs).collect())
    assert got == collections.Counter({(1, 1, 1): 2, (2, 1, 1): 1, (3, 1, 1): 1, (4, 4, 1): 1, (5, 4, 1): 1, (5, 5, 0): 1, (6, 6, 1): 2, (7, 7, 1): 2})
    kept = sorted((r.doc_id, r.text.split()[0]) for r in ngram_join.keep_one(docs).collect())
    assert kept == [(1, "a0"), (1, "b0"), (4, "c0"), (5, "d0"), (6, "e0"), (7, "f0")]


def test_bands_reach_the_recall():
    how = ngram_join.JaccardJoin()
    assert 1 - (1 - 0.8**how.rows) ** how.bands >= how.recall > 1 - (1 - 0.8**how.rows) ** (how.bands - 1)


# ---------------------------------------------------------------- 7 tokens

def test_token_shards_round_trip(docs, rows, empty, tmp_path):
    from tokenizers import Tokenizer

    how = token_shards.Encoding(word_pieces().tokenizer, block_ids=30_000, least_count=4)
    manifest = token_shards.write_shards(docs, str(tmp_path / "shards"), how)
    got = token_shards.read_shards(manifest).collect()
    tokenizer = Tokenizer.from_file(how.tokenizer)
    ids = [tokenizer.encode(t or "", add_special_tokens=False).ids + [1] for _, t, _ in rows]
    crc = lambda x: zlib.crc32(np.array(x, "<u4").tobytes())
    assert collections.Counter((r.doc_id, r.n_tokens, r.ids_crc32) for r in got) == collections.Counter(
        (d, len(x), crc(x)) for (d, _, _), x in zip(rows, ids))
    at = 0
    for r in sorted(got, key=lambda r: r.start):
        assert r.start == at
        at += r.n_tokens
    ordered = [r.doc_id for r in sorted(got, key=lambda r: r.start)]
    assert ordered == sorted(ordered, key=lambda d: (d is not None, d or 0))
    one = manifest.orderBy(F.desc("n_ids")).first()
    with open(one.path.removeprefix("file://"), "rb") as f:
        block = token_shards.Block(f.read())
    assert len(block.left) > 0
    for k in (0, len(block.doc_ids) - 1):
        whole = block.document(k)
        assert [block.token(k, i) for i in (0, len(whole) // 2, len(whole) - 1)] == whole[[0, len(whole) // 2, -1]].tolist()
    assert token_shards.encode_documents(empty, how).count() == 0


def test_tokens_learn_pieces_without_the_library_splitting_them_again(rows):
    """Ids are the library's; texts it has to split itself are those with unusual characters only."""
    tokens = token_shards.Tokens(word_pieces().tokenizer)
    whole, tokens.tokenizer = tokens.tokenizer, None
    odd = "It's 'tis THE o'rly?! ÀÇß ÿ 3.14 can't've\t a\r\nb  we'll--'d 'S $#@!~ don''t"
    texts = [odd, "", *[t for _, t, _ in rows if t and token_shards.is_usual(t)]]
    ids, counts = tokens.encode(texts)
    want = [whole.encode(t, add_special_tokens=False).ids for t in texts]
    assert counts.tolist() == [len(w) for w in want] and ids.tolist() == [i for w in want for i in w]
    assert not any(map(token_shards.is_usual, ("a<|b", "x\x1cy", "a\x7f", "\u0130", "a×b", "a\xa0b")))


def test_pieces_are_split_as_the_vocabulary_does():
    piece = re.compile(r"[a-zß-öø-ÿ]+|'(?:[stmd]|re|ve|ll)|[^\sa-zß-öø-ÿ0-9]+|[0-9]")
    rng = np.random.default_rng(8)
    alphabets = ("'strevlmdx", "'S l\n1-", "aÀÿß'!09 \t\r\n", bytes(token_shards.USUAL).decode("latin-1"))
    for k in range(2000):
        text = "".join(rng.choice(list(alphabets[k % 4]), rng.integers(0, 40)))
        data = text.encode("latin-1").translate(token_shards.LOWER) + b"\n" * 16
        starts, lengths = token_shards.split(data)
        assert [data[a:a + n].decode("latin-1") for a, n in zip(starts, lengths)] == piece.findall(text.lower()), text


def test_numbers_of_known_pieces():
    rng, known, held = np.random.default_rng(9), token_shards.Known(2), {}
    for _ in range(12):
        pairs = rng.integers(0, 60, (200, 2)).astype(np.uint64) << np.uint64(50)  # few places for many
        found = known.find(pairs[:, 0], pairs[:, 1]).tolist()
        assert found == [held.get((a, b), -1) for a, b in pairs.tolist()]
        new = list({(a, b) for a, b in pairs.tolist() if (a, b) not in held})
        numbers = np.arange(len(held), len(held) + len(new))
        known.add(*np.array(new, np.uint64).reshape(-1, 2).T.copy(), numbers)
        held |= zip(new, numbers.tolist())
    assert known.n == len(held) and len(known.number) >= 2 * known.n


def test_pieces_met_before_are_looked_up_together():
    """Only pieces that are new or longer than 16 bytes are looked up one by one."""
    class Counting(token_shards._Places):
        asked = 0

        def __getitem__(self, key):
            Counting.asked += 1
            return super().__getitem__(key)

    tokens = token_shards.Tokens(word_pieces().tokenizer)
    tokens.places = Counting()
    text = "It's a river of often seen words, 3 hills and one counterrevolutionaries; " * 50
    once = tokens.encode([text])
    assert Counting.asked == 14 + 50 and len(tokens.places) == 15
    twice = tokens.encode([text, "", "unseen"])
    assert Counting.asked == 14 + 50 + 50 + 1
    assert twice[0].tolist()[:len(once[0])] == once[0].tolist() == tokens.tokenizer.encode(text, add_special_tokens=False).ids


def test_pieces_met_again_are_kept_when_the_others_are_forgotten(monkeypatch):
    monkeypatch.setattr(token_shards, "MOST_CACHED", 40)
    tokens = token_shards.Tokens(word_pieces().tokenizer)
    whole = tokens.tokenizer
    often = "a river of often seen words"
    for i in range(30):
        texts = [often, f"rare{'xyz'[i % 3]}q{i} word{i}s " + " ".join(f"{chr(97 + i % 26)}{chr(97 + j)}ond" for j in range(12))]
        ids, counts = tokens.encode(texts)
        assert ids.tolist() == [x for t in texts for x in whole.encode(t, add_special_tokens=False).ids]
        assert len(tokens.places) == tokens.first.n == tokens.again.n <= 40 + 40 and (i < 2 or "river" in tokens.places)


def test_grammar_rounds_pair_what_stands_inside_documents_only():
    rng = np.random.default_rng(7)
    ids, how = rng.integers(2, 40, 60_000).astype(np.uint32), token_shards.Encoding("", least_count=4, pairs_per_round=64)
    counts = rng.multinomial(len(ids) - 300, [1 / 300] * 300) + 1
    ends = np.zeros(len(ids), bool)
    ends[np.cumsum(counts) - 1] = True
    pairs = collections.Counter((a << 32 | b) for a, b, e in zip(ids.tolist(), ids[1:].tolist(), ends.tolist()) if not e)
    want = sorted(pairs, key=lambda k: (-pairs[k], k))[:64]
    assert token_shards.frequent_pairs(ids, ends, 64, 4).tolist() == want
    before = ends.copy()
    left, right, symbols, left_ends = token_shards.compress(ids, ends, 50, how)
    assert (ends == before).all() and len(left) > 64 and left_ends.sum() == 300
    assert token_shards.expand(symbols, left, right, 50).tolist() == ids.tolist()


# ---------------------------------------------------------------- 8 suffix sorting

def test_suffix_array_of_small_texts():
    rng = np.random.default_rng(3)
    for _ in range(400):
        text = bytes(rng.integers(0, rng.integers(1, 4), rng.integers(0, 60)).astype(np.uint8))
        assert suffix_dedup.suffix_array(text) == sorted(range(len(text)), key=lambda i: text[i:])


@pytest.mark.parametrize("how", [suffix_dedup.Repeats(), suffix_dedup.Repeats(group_bytes=0)])
def test_repeats_are_removed(docs, rows, empty, how):
    data = [(d, (t or "").encode()) for d, t, _ in rows]
    seen = collections.Counter(b[i:i + 200] for _, b in data for i in range(len(b) - 199))
    want = collections.Counter()
    for d, b in data:
        gone = np.zeros(len(b) + 1, bool)
        for i in range(len(b) - 199):
            if seen[b[i:i + 200]] > 1:
                gone[i:i + 200] = True
        kept = bytes(c for c, g in zip(b, gone) if not g)
        spans = int((np.diff(np.concatenate([[0], gone.astype(int)])) == 1).sum())
        want[d, len(b), int(gone.sum()), spans, hashlib.sha256(kept).hexdigest()] += 1
    assert collections.Counter(tuple(r) for r in suffix_dedup.remove_repeats(docs, how).collect()) == want
    assert suffix_dedup.remove_repeats(empty, how).count() == 0


def test_texts_without_an_id_whose_crc32_collide(spark):
    rng = np.random.default_rng(12)
    letters = np.array(list("abcdefghijklmnopqrstuvwxyz "))
    passage, other = ("".join(rng.choice(letters, n)) for n in (300, 700))
    twice = f"{passage}{other[:50]}{passage}"
    ends = [hashlib.md5(str(i).encode()).hexdigest() for i in range(1 << 18)]
    sums = {zlib.crc32(f"{twice} {e}".encode()): e for e in ends}
    one, two = next((sums[h], e) for e in ends if (h := zlib.crc32(f"{other} {e}".encode())) in sums)
    given = [(None, f"{twice} {one}"), (None, f"{other} {two}")]
    assert len({zlib.crc32(t.encode()) for _, t in given}) == 1
    docs = spark.createDataFrame(given, "doc_id long, text string")
    prepare(spark)
    assert docs.selectExpr("xxhash64(text) AS h").first().h == suffix_dedup.text_sum(given[0][1].encode())
    got = {r.n_bytes: r.n_removed for r in suffix_dedup.remove_repeats(docs).collect()}
    assert got == {len(given[0][1]): 600, len(given[1][1]): 0}


def test_a_group_near_the_bound_is_sorted_in_little_memory():
    """Beside the text, numbers of four bytes; lists of numbers took 170 bytes for each byte of it."""
    rng = np.random.default_rng(4)

    def random(n):
        return rng.integers(97, 123, n).astype(np.uint8).tobytes()

    how, core, before, after = suffix_dedup.Repeats(), random(24), [random(60) for _ in range(9)], [random(150) for _ in range(9)]
    group = [(1, k, 80, random(20) + before[rng.integers(9)] + core + after[rng.integers(9)]) for k in range(400)]
    size = sum(len(c) for *_, c in group)
    tracemalloc.start()
    got = suffix_dedup.repeated_windows(group, how)
    most = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert most < 100 * size
    seen = collections.Counter(c[i:i + 200] for *_, c in group for i in range(len(c) - 199))
    want = {(k, 80 + i) for _, k, _, c in group for i in range(len(c) - 199) if seen[c[i:i + 200]] > 1}
    assert want and {(k, i) for _, k, x, y in got for i in range(x, y)} == want and len(got) == len({(k, x) for _, k, x, _ in got})


def test_segments_of_a_very_common_hash_can_be_split(spark):
    """Both sides of the join are plain shuffles, so that Spark splits a hot hash; a count on one side kept it in one task."""
    prepare(spark)
    segs = spark.range(300).selectExpr("id AS doc_id", "id AS crc", "if(id % 3 > 0, 7, id) AS v", "id AS digest", "id AS a", "1 AS n", "2 AS g")
    shared = suffix_dedup.shared_segments(segs)
    plan = shared._jdf.queryExecution().executedPlan().toString()
    assert "SortMergeJoin" in plan and "Aggregate" not in plan
    assert sorted(r.doc_id for r in shared.collect()) == [i for i in range(300) if i % 3]
    assert set(shared.columns) == set(segs.columns)


# ---------------------------------------------------------------- 9 licences

def test_licences_and_inheritance(spark):
    notice = licenses.NOTICES
    files = [("a/x.txt", f"head\n{notice['MIT']}\nbody the of"), ("a/LICENSE", notice["GPL-3.0"]),
             ("a/b/c/y", "nothing here"), ("a/b/LICENSE", notice["Apache-2.0"].upper()), ("a/b/c/z", None),
             ("q/w", "released under no licence that we know, in a longer line of prose"), (None, notice["MIT"]),
             ("a/z", ""), ("top", "x" * 100_000), ("a/x.txt", "again")]
    given = spark.createDataFrame(files, "path string, text string").withColumns({c: F.lit("clash") for c in ("license", "unit", "line_no", "is_license_file")})
    prepare(spark)
    got = collections.Counter((r.path, r.license, r.origin, r.from_dir) for r in licenses.scan_files(given).collect())
    assert got == collections.Counter([
        ("a/x.txt", "MIT", "own", None), ("a/x.txt", "MIT", "own", None), ("a/LICENSE", "GPL-3.0", "own", None),
        ("a/b/c/y", "Apache-2.0", "inherited", "a/b"), ("a/b/LICENSE", "Apache-2.0", "own", None),
        ("a/b/c/z", "Apache-2.0", "inherited", "a/b"), ("q/w", None, None, None), (None, None, None, None),
        ("a/z", "GPL-3.0", "inherited", "a"), ("top", None, None, None)])
    assert licenses.scan_files(given.where("false")).count() == 0


def test_units_of_a_file():
    lines = ["", "# one", "# two", "x = 1", "y = 2", "", "--", "z = 3", " "]
    singles = {(i, 1) for i in (1, 2, 3, 4, 7)}
    assert set(licenses.units(lines)) == singles | {(1, 2), (2, 2), (3, 2), (1, 3), (2, 3)} | {(1, 7)}
    assert list(licenses.units(["", " -- "])) == [] and list(licenses.units(["word"])) == [(0, 1)]


def wrapped(text, lead="", width=60):
    return "\n".join(lead + line for line in textwrap.wrap(" ".join(text.split()), width))


def test_headers_licence_files_and_prose(spark, docs):
    """Wrapped headers in comments, SPDX lines and whole texts are found; texts that talk of licences are not."""
    code = "import os\n\ndef main():\n    return os.getcwd()\n"
    mine = "Copyright (c) 2024 The Hill Walkers\n\n"
    want = {
        "p/apache.py": (wrapped(licenses.HEADERS["Apache-2.0"], "# ") + "\n" + code, "Apache-2.0", False),
        "p/mpl.c": ("/*\n" + wrapped(licenses.HEADERS["MPL-2.0"], " * ", 50) + "\n */\n" + code, "MPL-2.0", False),
        "p/gpl.js": (wrapped(licenses.HEADERS["GPL-3.0"], "// ") + "\n" + code, "GPL-3.0", False),
        "p/spdx.rs": ("// SPDX-License-Identifier: MIT\n" + code, "MIT", False),
        "p/spdx.go": ("// SPDX-License-Identifier: BSD-3-Clause\n" + code, "BSD-3-Clause", False),
        "p/split.md": ("A page about walks.\n\nReleased under\nthe MIT License.\n\nMore about walks.", "MIT", False),
        "mit/LICENSE": ("MIT License\n\n" + mine + wrapped(licenses.WHOLE["MIT"]), "MIT", True),
        "bsd3/COPYING": (mine + wrapped(licenses.WHOLE["BSD-3-Clause"], "", 72), "BSD-3-Clause", True),
        "bsd2/COPYING": (mine + wrapped(licenses.WHOLE["BSD-2-Clause"], "", 72), "BSD-2-Clause", True),
        "isc/any-name": (mine + wrapped(licenses.WHOLE["ISC"], "", 40), "ISC", True),
        "gpl/head": ("                    GNU GENERAL PUBLIC LICENSE\n                       Version 3, 29 June 2007\n", "GPL-3.0", True),
        "q/prose": ("Choosing a licence is hard. The MIT license is popular, the GNU General Public License is strict about changes "
                    "and the Apache License also speaks of patents.\nRead the license of each package before you ship it.", None, False),
        "q/plain": (code, None, False),
    }
    files = spark.createDataFrame([(p, t) for p, (t, *_) in want.items()] + [("mit/src/a.py", code), ("bsd3/b.py", code)], "path string, text string")
    corpus = files.unionByName(docs.selectExpr("concat('docs/', doc_id) AS path", "text"))
    prepare(spark)
    got = {r.path: r for r in licenses.scan_files(corpus).where("path NOT LIKE 'docs/%'").collect()}
    assert {p: (r.license, r.is_license_file) for p, r in got.items() if p in want} == {p: (name, whole) for p, (_, name, whole) in want.items()}
    assert (got["mit/src/a.py"].license, got["mit/src/a.py"].from_dir) == ("MIT", "mit")
    assert (got["bsd3/b.py"].license, got["bsd3/b.py"].origin) == ("BSD-3-Clause", "inherited")


def test_a_header_makes_a_licence_file_only_where_nothing_else_stands(spark):
    """A file that opens with a header says nothing for its directory, however short its own text."""
    header = wrapped(licenses.HEADERS["GPL-3.0"], "# ")
    given = spark.createDataFrame([("a/one.py", header + "\nrun()"), ("a/two.py", "walk"), ("b/HEAD", header), ("b/two.py", "walk")], "path string, text string")
    prepare(spark)
    got = {(r.path, r.license, r.origin, r.is_license_file) for r in licenses.scan_files(given).collect()}
    assert got == {("a/one.py", "GPL-3.0", "own", False), ("a/two.py", None, None, False),
                   ("b/HEAD", "GPL-3.0", "own", True), ("b/two.py", "GPL-3.0", "inherited", False)}


def test_words_of_the_corpus_are_counted_before_they_move(spark, docs):
    """Each task sends a row per distinct word, not per word of a file, whatever the words are then joined with."""
    files = docs.selectExpr("doc_id AS path", "text")
    prepare(spark)
    counts = licenses.document_counts(files)
    plan = counts._jdf.queryExecution().executedPlan().toString()
    assert plan.index("Exchange") < plan.index("partial_count") < plan.index("Generate") and plan.count("Exchange") == 1
    want = collections.Counter(w for r in files.collect() for w in set(re.findall(r"[^\W_]+", (r.text or "").lower())))
    got = {r.word: r.n for r in counts.collect()}
    assert {w: n for w, n in got.items() if w.isascii()} == {w: n for w, n in want.items() if w.isascii()}


def test_licence_query_takes_rows_without_id_source_or_language(spark, tmp_path):
    mit, gpl = licenses.NOTICES["MIT"], licenses.NOTICES["GPL-3.0"]
    given = [(None, mit, "en", "s", 1), (None, gpl, "en", "s", 1), (None, None, None, None, None), (5, mit, None, "s", 1),
             (6, "prose", "s", None, 1), (7, "prose", None, "s", 1)]
    spark.createDataFrame(given, SCHEMA).write.parquet(str(tmp_path / "documents.parquet"))
    got = collections.Counter((r.doc_id, r.license, r.origin) for r in queries.op9_license_scan(spark, str(tmp_path)).collect())
    assert got == collections.Counter([(None, "MIT", "own"), (None, "GPL-3.0", "own"), (None, None, None), (5, "MIT", "own"),
                                       (6, None, None), (7, "MIT", "inherited")])


def test_cosines_against_brute_force(spark, docs, rows):
    paths = docs.select(F.col("doc_id").cast("string").alias("path"), "text").where("path IS NOT NULL")
    got = {(r.path, r.line_no, r.n_lines): (r.license, round(r.cosine, 9)) for r in licenses.licensed_units(paths).collect()}
    split = lambda t: re.findall(r"[^\W_]+", (t or "").lower())
    files = [(str(d), t) for d, t, _ in rows if d is not None]
    df = collections.Counter(w for _, t in files for w in set(split(t)))
    weigh = lambda t: {w: n * (np.log((1 + len(files)) / (1 + df[w])) + 1) for w, n in collections.Counter(split(t)).items()}
    size = lambda v: np.sqrt(sum(x * x for x in v.values()))
    templates = [(name, v := weigh(t), size(v)) for name, t in licenses.standard_templates()]
    want = {}
    for path, text in files:
        lines = (text or "").split("\n")
        for i, n in licenses.units(lines):
            v = weigh("\n".join(lines[i:i + n]))
            if len(v) < 300:
                own = size(v)
                best = min(((-round(sum(v.get(w, 0) * x for w, x in t.items()) / own / norm, 12), name) for name, t, norm in templates))
                if -best[0] >= 0.8:
                    want[path, i, n] = (best[1], round(float(-best[0]), 9))
    assert got == want and want


# ---------------------------------------------------------------- 10 decontamination

def test_contamination_against_brute_force(spark, docs, rows, empty):
    items = table(spark, SF_DIR, "benchmark").unionByName(spark.createDataFrame(
        [(5001, None), (5002, ""), (5003, "ONE"), (None, "rivers and hills"), (5004, "copied PAGE about rivers")], "item_id long, text string"))
    fold = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    split = lambda t: re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", (t or "").translate(fold))
    windows = collections.defaultdict(set)
    for r in items.collect():
        w = split(r.text)
        for i in range(max(len(w) - 12, 1) if w else 0):
            windows[tuple(w[i:i + 13])].add(r.item_id)
    want = collections.Counter()
    for d, t, _ in rows:
        w, hit, met = split(t), set(), set()
        for n in {len(k) for k in windows}:
            for i in range(len(w) - n + 1):
                if tuple(w[i:i + n]) in windows:
                    met |= windows[tuple(w[i:i + n])]
                    hit |= set(range(i, i + n))
        named = sorted(str(m) for m in met if m is not None)
        want[d, len(w), len(hit), len(named), hashlib.sha256(",".join(named).encode()).hexdigest(),
             bool(hit) and 20 * len(hit) >= len(w)] += 1
    for how in (decontamination.Search(), decontamination.Search(rarest=1, broadcast_rows=0)):
        assert collections.Counter(tuple(r) for r in decontamination.contamination(docs, items, how).collect()) == want
    bad = {k[0] for k in want if k[-1]}
    kept = decontamination.keep_clean(docs, items)
    assert kept.columns == docs.columns and kept.count() == sum(n for k, n in want.items() if k[0] not in bad)
    assert decontamination.contamination(empty, items).count() == 0
    assert decontamination.contamination(docs, items.where("false")).where("n_hit > 0").count() == 0


def test_texts_that_share_an_id_are_judged_apart(spark):
    item = [f"w{i}" for i in range(13)]
    whole, odd, even, clean = " ".join(item), " x ".join(item[::2]), "x " + " x ".join(item[1::2]), "nothing of it at all"
    given = [(1, odd), (1, even), (None, whole), (None, clean), (3, whole), (3, clean), (4, clean)]
    docs = spark.createDataFrame(given, "doc_id long, text string").withColumns({c: F.lit(1) for c in ("digest", "doc", "_bad")})
    items = spark.createDataFrame([(1, whole, 0)], "item_id long, text string, digest int")
    hits = {(r.doc_id, r.n_words, r.n_hit) for r in decontamination.contamination(docs, items).collect()}
    assert hits == {(1, 13, 0), (1, 12, 0), (None, 13, 13), (None, 5, 0), (3, 13, 13), (3, 5, 0), (4, 5, 0)}
    kept = decontamination.keep_clean(docs, items)
    assert kept.columns == docs.columns
    assert sorted(map(str, kept.select("doc_id", "text").collect())) == sorted(
        map(str, spark.createDataFrame([g for g in given if g[1] != whole], "doc_id long, text string").collect()))


def test_proximity_takes_any_order(spark):
    docs = spark.createDataFrame([(1, "hills beyond the rivers"), (2, "hills " + "x " * 90 + "rivers"), (3, "rivers only")], "doc_id long, text string")
    items = spark.createDataFrame([(1, "rivers hills")], "item_id long, text string")
    index = decontamination.PositionalIndex(docs, items)
    assert {r.doc_id for r in index.proximity(50).collect()} == {1}
    assert index.matches().count() == 0
