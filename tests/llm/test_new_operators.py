"""SimHash near duplicates, tokenizer alignment and the Merkle manifest against plain versions, on nulls, empty and long texts, ties, repeated rows and empty tables."""

import hashlib
import random
import re
import zlib
from collections import Counter, defaultdict

import brute
import numpy as np
import pytest
import xxhash
from hypothesis import given, settings
from hypothesis import strategies as st

from harvestry.llm import alignment, merkle, simhash
from harvestry.llm.queries import tokenizer_file

KEY = lambda r: tuple((x is None, str(x)) for x in r)


def same(got, want):
    assert sorted(map(tuple, got), key=KEY) == sorted(map(tuple, want), key=KEY)


# SimHash


def plain_print(text):
    words = brute.BLANK.findall(brute.lower(text))
    if not words:
        return 0
    hashes = [xxhash.xxh64_intdigest(" ".join(words[k : k + 3]).encode(), 42) for k in range(max(1, len(words) - 2))]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def plain_links(prints, radius=3):
    """Smallest label of each print's component."""
    label = {p: p for p in prints}

    def top(p):
        while label[p] != p:
            p = label[p]
        return p

    values = sorted(label)
    for k, a in enumerate(values):
        for b in values[k + 1 :]:
            if (a ^ b).bit_count() <= radius:
                x, y = sorted((top(a), top(b)))
                label[y] = x
    return {p: top(p) for p in values}


def test_simhash(docs, rows):
    prints = [plain_print(t) for _, t in rows]
    roots, least = plain_links(set(prints)), {}
    for (doc_id, _), p in zip(rows, prints):
        if doc_id is not None:
            least[roots[p]] = min(doc_id, least.get(roots[p], doc_id))
    same(simhash.near_duplicates(docs).collect(), [(i, f"{p:016x}", least.get(roots[p])) for (i, _), p in zip(rows, prints)])


def test_simhash_of_nothing(no_docs):
    assert simhash.near_duplicates(no_docs).count() == 0


def flipped(pick, base, most):
    for b in pick.sample(range(64), pick.randint(0, most)):
        base ^= 1 << b
    return base


@pytest.mark.parametrize("prints,part", [(10, 4096), (10**6, 7), (10**9, 4096), (10**14, 4096)])
def test_links_of_every_cut_and_of_parts(spark, monkeypatch, prints, part):
    """Whatever the tables' keys and the parts of large shards, components are those of all pairs; a large group is more than one part."""
    pick = random.Random(prints)
    centres = [pick.getrandbits(64) for _ in range(6)]
    made = {flipped(pick, pick.choice(centres), 5) for _ in range(400)} | {0, 1, (1 << 64) - 1, 1 << 63}
    monkeypatch.setattr(simhash, "PART_ROWS", part)
    keys = simhash.tables(3, prints)
    monkeypatch.setattr(simhash, "tables", lambda radius, n: keys)
    signed = [(p - (1 << 64) if p >> 63 else p,) for p in made]
    links = simhash.links(spark.createDataFrame(signed, "print long"))
    found = links.collect()
    assert all(0 < ((a ^ b) & ((1 << 64) - 1)).bit_count() for a, b in found)
    parent = {p: p for (p,) in signed}

    def top(p):
        while parent[p] != p:
            p = parent[p]
        return p

    for a, b in found:
        parent[top(a)] = top(b)
    groups, want = defaultdict(set), defaultdict(set)
    for (p,) in signed:
        groups[top(p)].add(p & ((1 << 64) - 1))
    for p, root in plain_links(made).items():
        want[root].add(p)
    assert sorted(map(sorted, groups.values())) == sorted(map(sorted, want.values()))


def test_keys_of_all_tables_cover_the_radius():
    for prints in (1, 10**7, 10**10, 10**13):
        keys = simhash.tables(3, prints)
        for _ in range(50):
            apart = sum(1 << b for b in random.sample(range(64), 3))
            assert any(not apart & k for k in keys)


@settings(max_examples=60, deadline=None)
@given(st.lists(st.tuples(st.integers(0, 2), st.integers(0, 63)), max_size=60, unique=True), st.integers(0, 4), st.sampled_from([1, 30, 10**6]))
def test_trees_find_what_brute_force_finds(items, radius, frontier):
    items.sort()
    shard, value = np.array([s for s, _ in items], np.int64), np.array([v for _, v in items], np.uint64)
    with pytest.MonkeyPatch.context() as patch:
        patch.setattr(simhash, "FRONTIER", frontier)
        found = {(int(q), int(n)) for query, node in simhash.Forest(shard, value).search(shard, value, radius) for q, n in zip(query, node)}
    assert found == {(a, b) for a in range(len(items)) for b in range(len(items)) if shard[a] == shard[b] and (items[a][1] ^ items[b][1]).bit_count() <= radius}


# Alignment


@pytest.fixture(scope="module")
def aligner():
    return alignment.Aligner(tokenizer_file("byte_bpe_50k.json"), tokenizer_file("piece_bpe_32k.model"))


def plain_alignment(aligner, text):
    """``n_a, n_b, groups, links`` from the whole text at once; None if a side does not give the bytes back."""
    if not text:
        return None
    a, b, whole = aligner.a.encode(" " + text, add_special_tokens=False).ids, aligner.b.encode(text), (" " + text).encode()
    a_ends, b_ends = np.cumsum(aligner.a_sizes[a]).tolist(), np.cumsum([len(aligner.b_bytes[k]) for k in b]).tolist()
    if b"".join(aligner.b_bytes[k] for k in b) != whole or a_ends[-1] != len(whole):
        return None
    links = [(a[i], b[j]) for i in range(len(a)) for j in range(len(b)) if ([0, *a_ends][i] < b_ends[j] and [0, *b_ends][j] < a_ends[i])]
    groups, start = [], 0
    for end in sorted(set(a_ends) & set(b_ends)):
        groups.append("|".join(",".join(str(k) for k, e in zip(ids, ends) if start < e <= end) for ids, ends in ((a, a_ends), (b, b_ends))))
        start = end
    return len(a), len(b), groups, links


ODD = ["<|endoftext|> x", "</s>", "<s> <unk>", " ", "\n", "a  ", "a \n b", "<0x41>", "x▁y", "a\tb\r\nc", "ab c ", "日本語 😀🏽", "é ﬁ", "a\x00b", "don't stop", " lead", "x" * 300, "a　b\x85c"]


@settings(max_examples=120, deadline=None)
@given(st.text(alphabet="ab AB\n '.,!12éß日語😀▁<s>|\t́　", max_size=30))
def test_units_align_like_whole_texts(aligner, text):
    check_text(aligner, text)


def test_odd_texts(aligner):
    for text in ODD:
        check_text(aligner, text)


def check_text(aligner, text):
    (got,), want = aligner.texts([text]), plain_alignment(aligner, text)
    assert (got is None) == (want is None)
    if want:
        n_a, n_b, groups, links = want
        pairs = Counter(dict(zip(np.frombuffer(got[5], np.int64).tolist(), np.frombuffer(got[6], np.uint32).tolist())))
        assert got[:5] == (n_a, n_b, len(groups), len(links), hashlib.sha256(";".join(groups).encode()).hexdigest())
        assert pairs == Counter(a * alignment.B_IDS + b for a, b in links)


@pytest.mark.parametrize("block", [1_000_000, 40])
def test_alignment(spark, aligner, monkeypatch, block):
    monkeypatch.setattr(alignment, "BLOCK_PAIRS", block)
    pick = random.Random(4)
    texts = [" ".join(pick.choices(["the", "ansten", "of", "Über", "x,", "日本", "antion\nthe", "12"], k=pick.choice((1, 6, 25)))) for _ in range(40)]
    texts += texts[:5] * 3 + ODD + ["", None, None]
    rows = list(enumerate(texts)) + [(0, texts[0]), (None, "the of")]
    made = [(i, plain_alignment(aligner, t)) for i, t in rows]
    counts = Counter(p for _, m in made if m for p in set(m[3]))
    top = defaultdict(int)
    for (a, _), n in counts.items():
        top[a] = max(top[a], n)
    want = [(i, m[0], m[1], len(m[2]), len(m[3]), sum(counts[p] == top[p[0]] for p in m[3]), sum(counts[p] for p in m[3]), hashlib.sha256(";".join(m[2]).encode()).hexdigest()) if m else (i, *[0] * 6, "") for i, m in made]
    df = spark.createDataFrame([(*r, 1, "c") for r in rows], "doc_id long, text string, copies int, text_key string").repartition(3)
    files = tokenizer_file("byte_bpe_50k.json"), tokenizer_file("piece_bpe_32k.model")
    same(alignment.align(df, *files).collect(), want)
    if block > 40:
        assert alignment.align(df.limit(0), *files).count() == 0 and {tuple(r)[1:] for r in alignment.align(df.where("text is null or text = ''"), *files).collect()} == {(0, 0, 0, 0, 0, 0, "")}


# Manifest


def sha(*parts):
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def plain_tree(nodes):
    """Root, and for every leaf its (left, right) siblings level by level."""
    own, steps = [[k] for k in range(len(nodes))], [[] for _ in nodes]
    while len(nodes) > 1:
        runs = [nodes[k : k + 16] for k in range(0, len(nodes), 16)]
        for r, run in enumerate(runs):
            for j in range(len(run)):
                for k in own[16 * r + j]:
                    steps[k].append((run[:j], run[j + 1 :]))
        nodes, own = [sha(*run) for run in runs], [sum(own[k : k + 16], []) for k in range(0, len(own), 16)]
    return nodes[0], steps


def plain_manifest(rows):
    """Rows are doc_id, source, lang, n_chars, text."""
    shown = lambda v: "-" if v is None else f"{len(str(v).encode())}:{v}"
    leaf = lambda r: sha(*map(shown, r))
    by = defaultdict(list)
    for r in rows:
        by[r[1]].append(r)
    order = sorted(by, key=lambda s: (s is not None, (s or "").encode()))
    made = {}
    for s in order:
        own = sorted(by[s], key=lambda r: (r[0] is not None, r[0] or 0, leaf(r)))
        made[s] = own, *plain_tree([leaf(r) for r in own])
    root, above = plain_tree([made[s][1] for s in order])
    out = []
    for s, up in zip(order, above):
        own, subroot, steps = made[s]
        for r, path in zip(own, steps):
            changed = r[0] is not None and zlib.crc32(str(r[0]).encode()) % 5 == 0
            node = leaf((*r[:4], brute.lower(r[4]) if changed and r[4] is not None else r[4]))
            for left, right in path + up:
                node = sha(*left, node, *right)
            out.append((r[0], leaf(r), subroot, root, sha(*(x for left, right in path + up for x in (*left, *right))), node, node == root))
    return out


def test_manifest(spark):
    """Sources of one row, of full and of broken runs, of several rounds; more than one run of sources; nulls and repeated rows."""
    rows = [(k, "hot", "en", 3, f"Text {k} É") for k in range(700)] + [(k, "full", None, None, "") for k in range(256)] + [(k, "seventeen", "x", k, None) for k in range(17)]
    rows += [(k, f"s{k}é", "en", 1, "A") for k in range(30)] + [(None, None, None, None, None), (None, "hot", "a", 1, "B"), (5, None, "en", 2, "Z" * 100_000), (5, "hot", "en", 3, "Text 5 É"), (5, "hot", "en", 3, "other"), (7, "", "", 0, "x:y-")]
    df = spark.createDataFrame([(*r, 1, "c") for r in rows], "doc_id long, source string, lang string, n_chars long, text string, at int, key string").repartition(5)
    got = merkle.manifest(df).collect()
    same(got, plain_manifest(rows))
    assert not all(r["verified"] for r in got) and sum(r["verified"] for r in got) > 700


def test_manifest_of_little(spark, no_docs):
    assert merkle.manifest(no_docs).count() == 0
    (row,) = merkle.manifest(spark.createDataFrame([(1, "s", "l", 1, "t")], "doc_id long, source string, lang string, n_chars long, text string")).collect()
    assert row["leaf"] == row["subroot"] == row["root"] == row["folded_root"] and row["proof_sha256"] == sha("") and row["verified"]


def test_later_siblings_extend_open_witnesses():
    """A witness taken early grows as siblings come in, and folds to the root once the tree is closed."""
    tree, nodes = merkle.Tree(), [sha(str(k)) for k in range(40)]
    places = [tree.append(n) for n in nodes[:5]]
    assert places[0][0] is places[4][0] and len(places[0][0].digests) == 5
    places += [tree.append(n) for n in nodes[5:]]
    root = tree.finish(2)
    assert root == plain_tree(nodes)[0] and all(merkle.fold(n, merkle.witness(p, 2)) == root for n, p in zip(nodes, places))


# Pages


def test_a_growing_host_keeps_the_same_article_blocks():
    """A sentence on nine of a hundred pages stays whatever the host's size; one between other blocks stays on a third of the pages, a notice at the end goes."""
    from harvestry.llm import mainhtml

    said = " ".join(f"said{k}" for k in range(30))
    third = " ".join(f"third{k}" for k in range(30))
    notice = " ".join(f"notice{k}" for k in range(30))
    for n in (100, 1000):
        own = [" ".join(f"own{k}x{j}" for j in range(20)) for k in range(n)]
        bodies = [[own[k], *([said] if k % 100 < 9 else []), *([third] if k % 3 == 0 else []), f"By author {k}"] for k in range(n)]
        pages = ["<article>" + "".join(f"<p>{b}</p>" for b in body) + f"<p>{notice}</p></article>" for body in bodies]
        got = mainhtml.keep([mainhtml.blocks(p) for p in pages], list(range(n)))
        assert got == ["\n\n".join(body) for body in bodies]
