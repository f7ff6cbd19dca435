"""Spelling variants, bottom-k sketches and the conversation trie against brute-force versions."""

import collections
import hashlib
import random
import re
import zlib

import pytest
from pyspark.sql import functions as F

from veritally.llm import bottom_sketches, conversation_trie, queries, spelling_variants
from veritally.llm.common import prepare, table

SF_DIR = "/root/testdata/sf0.001"
DOCUMENTS = "doc_id long, text string, lang string, source string, n_chars long"
TURNS = "conv_id long, turn long, role string, text string"
CLASHING = ["word", "n", "form", "root", "key", "sum", "node", "list", "sketch", "component", "a", "b", "conv", "at", "id", "cont",
            "level", "head", "least", "_id", "_sum", "first", "size"]


def with_clashes(rows):
    return rows.withColumns({c: F.lit("clash") for c in CLASHING if c not in rows.columns})


# Spelling variants.

def brute_variants(rows):
    counts = collections.Counter()
    for doc_id, text in rows:
        lowered = re.sub("[A-Z]", lambda m: m.group().lower(), text or "")
        for run in re.findall("[a-zÀ-ÿ]+", lowered):
            h = zlib.crc32(f"{'' if doc_id is None else doc_id}:{run}".encode())
            counts[run[:h % len(run)] + run[h % len(run) + 1:] if h % 199 == 0 else run] += 1
    n = {w: c for w, c in counts.items() if len(w) >= 6 and c >= 5}
    holes = collections.defaultdict(set)  # one letter left out, or one position open
    for w in n:
        for i in range(len(w)):
            holes[w[:i] + w[i + 1:]].add(w)
            holes[w[:i] + "?" + w[i + 1:]].add(w)
    near = collections.defaultdict(set)
    for hole, group in holes.items():
        for w in group | ({hole} & n.keys()):
            near[w] |= (group | {hole} & n.keys()) - {w} if "?" in hole else {hole} & n.keys() if w != hole else group - {w}
    out, forms = {}, {}
    for w in n:
        best = min(near[w], key=lambda x: (-n[x], x), default=None)
        if best is not None and n[best] >= 5 * n[w]:
            forms[w] = best
    for w in n:
        root = w
        while root in forms:
            root = forms[root]
        out[w] = (forms.get(w), root, n[w], len(near[w]), n[forms[w]] if w in forms else None)
    return out


def shown(result):
    return {r.word: (r.form, r.root, r.n, r.n_near, r.form_n) for r in result.collect()}


@pytest.fixture(scope="module")
def wordy(spark):
    rng = random.Random(5)
    base = ["election", "würdig", "übermäßig", "banana", "thththth", "oooooo", "Straße×Weg", "nation÷al", "ERSTEN"]
    rows = [(None, "election " * 30), (7, None), (8, ""), (9, "!!! 12 %%"), (7, "election election"), (7, "election election"),
            (8000, "quadrant " * 300 + "quadrants " * 40 + "quadrantsy " * 6)]
    for i in range(3000):
        w = rng.choice(base)
        kind, at, c = rng.randrange(9), rng.randrange(len(w)), rng.choice("abeou")
        w = w[:at] + w[at + 1:] if kind == 0 else w[:at] + c + w[at:] if kind == 1 else w[:at] + c + w[at + 1:] if kind == 2 else w
        rows.append((rng.randrange(-50, 900), f"{w}, {w.upper()}; {rng.choice(base)}"))
    return rows


def test_variants_match_brute_force(spark, wordy):
    prepare(spark)
    docs = with_clashes(spark.createDataFrame(wordy, "doc_id long, text string"))
    got = shown(spelling_variants.variant_groups(docs))
    assert got == brute_variants(wordy)
    assert any(form and root != form for form, root, *_ in got.values()), "no chain of forms among them"
    assert not spelling_variants.variant_groups(docs.where("false")).collect()


def test_variants_of_the_whole_table(spark):
    rows = [tuple(r) for r in table(spark, SF_DIR, "documents").select("doc_id", "text").collect()]
    assert shown(queries.op11_spelling_variants(spark, SF_DIR)) == brute_variants(rows)


def test_words_one_edit_apart_share_a_signature():
    how, rng = spelling_variants.Variants(), random.Random(3)
    for _ in range(3000):
        w = "".join(rng.choice("aabbcdé") for _ in range(rng.randrange(6, 15)))
        at, c = rng.randrange(len(w) + 1), rng.choice("abxé")
        for other in (w[:at] + c + w[at:], w[:at] + c + w[at + 1:]):
            short = min(len(w), len(other))
            one, two = ({s for s, length, _ in spelling_variants.signatures(x, how) if length == short} for x in (w, other))
            assert one & two


# Bottom-k sketches.

def shingles(text, n=2):
    words = [w for w in re.split(r"[\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m.group().lower(), text or "")) if w]
    return {tuple(words[i:i + n]) for i in range(max(1, len(words) - n + 1))} if words else set()


def brute_components(rows):
    """(doc_id, n_shingles, component_id, kept) of each row."""
    sets = [frozenset(shingles(text)) for _, text in rows]
    distinct = list({s for s in sets if s})
    root = {s: s for s in distinct}

    def find(s):
        while root[s] is not s:
            s = root[s]
        return s

    for i, x in enumerate(distinct):
        for y in distinct[:i]:
            if 100 * min(len(x), len(y)) >= 80 * max(len(x), len(y)):
                common = len(x & y)
                if 100 * common >= 80 * (len(x) + len(y) - common):
                    root[find(x)] = find(y)
    least = {}
    for (doc_id, _), s in zip(rows, sets):
        if s and doc_id is not None:
            least[find(s)] = min(doc_id, least.get(find(s), doc_id))
    out = collections.Counter()
    for (doc_id, _), s in zip(rows, sets):
        component = least.get(find(s)) if s else doc_id
        out[doc_id, len(s), component, doc_id == component if component is not None else True] += 1
    return out


def edited(rng, words, share):
    return [w if rng.random() > share else f"{w}{rng.randrange(99)}" for w in words]


@pytest.fixture(scope="module")
def copies():
    rng = random.Random(8)
    vocabulary = [f"w{i}" for i in range(300)]
    rows = [(None, "alone without an id"), (None, "a b c d e f g h i j k l"), (50, "A b c d e f g\th i j k l"), (51, None), (52, ""), (53, " \n "),
            (54, "one"), (55, "ONE"), (56, "one two"), (57, "one two three four five six"), (58, "one two three four five six seven"),
            (59, "x y z"), (59, "one two"), (59, "one two"), (60, "É one two three four five"), (61, "é one two three four five")]
    for i in range(12):
        hub = rng.choices(vocabulary, k=rng.choice([6, 9, 12, 30, 80, 200, 700]))
        for j in range(rng.choice([2, 5, 25])):
            rows.append((100 + 100 * i + j, " ".join(edited(rng, hub, rng.choice([0, 0.02, 0.05, 0.08])))))
    template = rng.choices(vocabulary, k=60)
    rows += [(5000 + i, " ".join(template + rng.choices(vocabulary, k=rng.choice([10, 60])))) for i in range(120)]
    words = rng.choices(vocabulary, k=100)  # a chain: each near the next, the ends far apart
    for i in range(30):
        words = words[4:] + [f"c{i}x{j}" for j in range(4)]
        rows.append((7000 - i, " ".join(words)))
    return rows


@pytest.mark.parametrize("how", [bottom_sketches.Sketches(), bottom_sketches.Sketches(block=4, list_block=10, star_rounds=1)])
def test_components_match_brute_force(spark, copies, how):
    prepare(spark)
    docs = with_clashes(spark.createDataFrame(copies, "doc_id long, text string"))
    got = collections.Counter(tuple(r) for r in bottom_sketches.near_duplicates(docs, how).collect())
    assert got == brute_components(copies)
    assert max(collections.Counter(c for _, _, c, _ in got).values()) > 20
    assert not bottom_sketches.near_duplicates(docs.where("false")).collect()


def test_components_of_the_whole_table(spark):
    rows = [tuple(r) for r in table(spark, SF_DIR, "documents").select("doc_id", "text").collect()]
    result = queries.op12_bottom_sketches(spark, SF_DIR)
    assert result.columns == ["doc_id", "n_shingles", "component_id", "kept"]
    assert collections.Counter(tuple(r) for r in result.collect()) == brute_components(rows)


# Conversation trie.

def brute_trie(rows):
    turns = collections.defaultdict(list)
    for conv, turn, role, text in rows:
        if conv is not None:
            turns[conv].append((turn is not None, turn or 0, role or "", text or ""))
    original = {c: [(t[2], t[3]) for t in sorted(x, key=lambda t: (t[:2], t[2].encode(), t[3].encode()))] for c, x in turns.items()}
    rebuilt = {}
    for c in original:
        h = zlib.crc32(str(c).encode()) % 9
        base = c - (abs(c) % 5) * (1 if c >= 0 else -1)
        rebuilt[c] = tuple(original.get(base, [])[:h] + original[c][h:])
    members = collections.defaultdict(list)
    for c, seq in rebuilt.items():
        for d in range(len(seq) + 1):
            members[seq[:d]].append(c)
    below = collections.defaultdict(list)
    for seq in members:
        if seq:
            below[seq[:-1]].append(seq)
    sums = {}
    for seq in sorted(members, key=len, reverse=True):
        own = (len(members[seq]) - 1) * len(seq[-1][1].encode()) if seq else 0
        parts = [sums[b] for b in below[seq]]
        sums[seq] = (sum(p[0] for p in parts) or 1, own + sum(p[1] for p in parts))
    out = collections.Counter()
    for seq, convs in members.items():
        ends = ",".join(map(str, sorted(c for c in convs if len(rebuilt[c]) == len(seq))))
        out[min(convs), len(seq), min(members[seq[:-1]]) if seq else None, len(convs), len(below[seq]), *sums[seq],
            hashlib.sha256(ends.encode()).hexdigest()] += 1
    return out


@pytest.fixture(scope="module")
def talks():
    rng = random.Random(4)
    rows = [(None, 1, "user", "lost"), (3, None, None, None), (3, 2, "user", None), (3, 2, "user", None), (-7, 1, "user", "minus"), (11, 1, "a", "bc"), (16, 1, "ab", "c")]
    paths = [[("user", rng.choice(["hi", "ho", "é"]))] for _ in range(40)]
    for i in range(300):
        path = list(rng.choice(paths))
        for _ in range(rng.randrange(4)):
            path.append((rng.choice(["user", "assistant"]), rng.choice(["yes", "no", "", "long " * 30])))
        paths.append(path[:rng.randrange(1, 40)])
        rows += [(20 + i, t, *turn) for t, turn in enumerate(path)]
    long = [("user", f"turn {t}") for t in range(90)]
    for c in (1000, 1001, 1002, 1005, 1010, 1015):
        rows += [(c, t, *turn) for t, turn in enumerate(long[:90 - c % 7])]
    return rows


@pytest.mark.parametrize("how", [conversation_trie.Burst(), conversation_trie.Burst(stretch=8, most=20), conversation_trie.Burst(stretch=1, most=1)])
def test_trie_matches_brute_force(spark, talks, how):
    prepare(spark)
    if how.stretch == 1:
        talks = [r for r in talks if (r[0] or 0) < 50]
    given = with_clashes(spark.createDataFrame(talks, TURNS))
    got = collections.Counter(tuple(r) for r in conversation_trie.trie_nodes(given, how).collect())
    assert got == brute_trie(talks)
    assert not conversation_trie.trie_nodes(given.where("false")).collect()


def test_trie_of_the_whole_table(spark):
    rows = [tuple(r) for r in table(spark, SF_DIR, "conversations").select("conv_id", "turn", "role", "text").collect()]
    result = queries.op13_conversation_trie(spark, SF_DIR)
    assert result.columns == ["conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256"]
    assert collections.Counter(tuple(r) for r in result.collect()) == brute_trie(rows)
