"""Each operator against a plain version, on nulls, empty and long texts, ties, repeated rows, empty tables and clashing columns."""

import re
import struct
import zlib
from collections import Counter, defaultdict

import brute
import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from harvestry.llm import chat, decontam, hostrep, jaccard, linerules, mainhtml, packing, pii, quality, toxicity
from harvestry.llm.queries import tokenizer_file

KEY = lambda r: tuple((x is None, str(x)) for x in r)


def same(got, want):
    assert sorted(map(tuple, got), key=KEY) == sorted(map(tuple, want), key=KEY)


# Packing


@pytest.fixture(scope="module")
def tokenizer():
    from tokenizers import Tokenizer

    return Tokenizer.from_file(tokenizer_file())


ODD = ["don't a'S I'M <|endoftext|>x <|startoftext|>", "İstanbul ÀÉ, x y z\x85w a\x1cb \x1d c", "é ́x ﬁ Σας ΣΑΣ, 3.14 １２ ß ẞ", "", "  ", "'s's ''re", "ab×, a÷b É! Ñ?", "​zero​", "日本 語。", "a\x0bb\x0cc", "x'd'll 12ab34"]


def test_encoder_is_exact(tokenizer):
    own = packing.WordEncoder(tokenizer_file())
    for text in ODD:
        assert np.frombuffer(own.encode(text), "<u4").tolist() == tokenizer.encode(text, add_special_tokens=False).ids


@settings(max_examples=150, deadline=None)
@given(st.text(alphabet="aBcé ÀßÑ'st.,!?<|>#12×\x1c\x85\n\t\u0301日", max_size=40))
def test_encoder_property(text):
    from tokenizers import Tokenizer

    if not hasattr(test_encoder_property, "own"):
        test_encoder_property.own = packing.WordEncoder(tokenizer_file()), Tokenizer.from_file(tokenizer_file())
    own, plain = test_encoder_property.own
    assert np.frombuffer(own.encode(text), "<u4").tolist() == plain.encode(text, add_special_tokens=False).ids


def test_pack(docs, rows, tokenizer):
    got = packing.pack(docs, tokenizer_file(), 256).collect()
    want = []
    for doc_id, text in rows:
        ids = tokenizer.encode(text or "", add_special_tokens=False).ids + [0]
        for at in range(0, len(ids), 256):
            own = ids[at : at + 256]
            want.append((doc_id, at // 256, at, len(own), zlib.crc32(struct.pack(f"<{len(own)}I", *own))))
    same([tuple(r)[:5] for r in got], want)
    bins = defaultdict(list)
    for r in got:
        bins[r["sequence_id"]].append((r["offset"], r["length"]))
    for spans in bins.values():
        end = 0
        for offset, length in sorted(spans):
            assert offset == end
            end += length
        assert end <= 256
    assert len(bins) <= 1.02 * -(-sum(w[3] for w in want) // 256) + 1


def test_pack_nothing(no_docs):
    assert packing.pack(no_docs, tokenizer_file()).count() == 0


@pytest.mark.parametrize("score", ["norm", "dot"])
def test_plan_keeps_all_capacities(score):
    counts = {1: 50, 7: 13, 30: 9, 64: 2, 70: 4}
    plan = packing.plan_bins(counts, 100, max_docs=6, max_cost=6000, score=score)
    bins = defaultdict(list)
    for length, first, uses, base, offset in zip(plan.length, plan.first, plan.uses, plan.bin, plan.offset):
        after = [f for n, f in zip(plan.length, plan.first) if n == length and f > first]
        given_ = (min(after) if after else counts[length]) - first
        for k in range(given_):
            bins[base + k // uses].append(int(length))
    assert Counter(n for b in bins.values() for n in b) == counts
    for b in bins.values():
        assert sum(b) <= 100 and len(b) <= 6 and sum(n * n for n in b) <= 6000


def test_a_piece_over_a_capacity_is_told():
    with pytest.raises(ValueError):
        packing.plan_bins({10: 1}, 10, max_cost=50)


# Decontamination


@pytest.fixture(scope="module")
def items(spark, rows):
    texts = [t for _, t in rows if t]
    long = texts[5].split() * 3
    given_ = [(1, " ".join(long[4:20])), (2, "W1 w2"), (3, "one"), (3, "Two, words"), (4, None), (5, " .. "), (None, " ".join(texts[9].split()[:12])), (10, " ".join(long[4:20])), (6, "never seen words at all in any of the texts here")]
    return spark.createDataFrame(given_, "item_id long, text string"), given_


def test_contamination(docs, rows, items):
    table, given_ = items
    got = decontam.matches(docs, table).collect()
    from hashlib import sha256

    same([(r["doc_id"], r["n_words"], len(r["places"]), len(r["items"]), sha256(",".join(r["items"]).encode()).hexdigest(), bool(r["places"])) for r in got], brute.decontaminated(rows, given_))
    assert all((r["longest"] > 0) == bool(r["places"]) and r["longest"] <= len(r["places"]) for r in got)


def test_contamination_in_many_blocks(docs, rows, items, monkeypatch):
    table, given_ = items
    monkeypatch.setattr(decontam, "BLOCK_CHARS", 200)
    assert len(decontam.test_blocks(table)) > 1
    same([(r["doc_id"], r["n_words"], len(r["places"]), len(r["items"])) for r in decontam.matches(docs, table).collect()], [w[:4] for w in brute.decontaminated(rows, given_)])
    want = [w[0] for w in brute.decontaminated(rows, given_) if not w[5]]
    kept = decontam.decontaminate(docs, table)
    assert kept.columns == docs.columns
    same([(r["doc_id"],) for r in kept.collect()], [(w,) for w in want])


def test_contamination_of_nothing(docs, no_docs, items):
    assert decontam.matches(no_docs, items[0]).count() == 0
    assert decontam.matches(docs, items[0].limit(0)).where("size(places) > 0").count() == 0


# Near duplicates


def test_near_duplicates(docs, rows):
    same(jaccard.near_duplicates(docs).collect(), brute.near_duplicates(rows))


def test_near_duplicates_one_stays(docs, rows):
    kept = jaccard.drop_near_duplicates(docs)
    assert kept.columns == docs.columns
    want = brute.near_duplicates(rows)
    ids = {(c, i) for i, n, c in want if n and i == c}
    got = [r["doc_id"] for r in kept.collect()]
    assert sorted(i for i in got if i is not None) == sorted([i for _, i in ids if i is not None] + [i for i, n, _ in want if not n and i is not None])
    assert got.count(None) == 2  # the one with words, and the one without


def test_near_duplicates_of_nothing(no_docs):
    assert jaccard.near_duplicates(no_docs).count() == 0


def test_blocks_and_rounds_lose_no_link(spark, monkeypatch):
    """Small blocks, no rounds before the last: all pairs of components are still verified."""
    import random

    monkeypatch.setattr(jaccard, "BLOCK_ROWS", 5)
    monkeypatch.setattr(jaccard, "STAR_ROUNDS", ())
    pick, given_ = random.Random(3), []
    for _ in range(4):
        base = [f"w{pick.randrange(500)}" for _ in range(60)]
        for _ in range(15):
            own = list(base)
            for _ in range(pick.choice((1, 1, 2))):
                own[pick.randrange(60)] = f"n{pick.randrange(9)}"
            given_.append((len(given_), " ".join(own)))
    same(jaccard.near_duplicates(spark.createDataFrame(given_, "doc_id long, text string")).collect(), brute.near_duplicates(given_))


def grams_of(text, size=5):
    words = (text or "").encode().lower().split()
    return {tuple(words[k : k + size]) for k in range(max(len(words) - size + 1, 1))} if words else set()


def sets_of(texts):
    import pyarrow as pa

    given_ = pa.record_batch([pa.array(range(len(texts))), pa.array(texts, pa.string())], names=["doc_id", "text"])
    return [own.tolist() for _, sets in jaccard._shingled(iter([given_.slice(1, 0), given_.slice(1)]), 1, 5) for own in sets]


def compare_sets(texts):
    """A hash for each n-gram, in order, and the same ones for the same n-grams, whatever text stands beside them."""
    got = sets_of(["left out", *texts])
    assert got == [jaccard.shingle_set(t).tolist() for t in texts]
    assert all(own == sorted(set(own)) and len(own) == len(grams_of(t)) for own, t in zip(got, texts, strict=True))
    for one, t in zip(got, texts):
        for two, u in zip(got, texts):
            assert len(set(one) & set(two)) == len(grams_of(t) & grams_of(u))


ODD_WORDS = ["a b c d E f", "A B C D e F", "a b c d", "a b c", "d e f g h", None, "", " \t", "a\x1cb \xa0c\x85d e\x0bf\x0cg\rh", "12345678 1234567 123456789 12345678 1234567 123456789", "\0 \0\0 a a\0 a\0\0 b",
             "x" * 16 + " " + "X" * 17 + " " + "x" * 24, "É é İ [ @ ` { z Z", "日本 語 日本 語 日本 語 日本 語", "w " * 40, " lead", "trail "]


def test_sets_of_odd_texts(monkeypatch):
    compare_sets(ODD_WORDS)
    monkeypatch.setattr(jaccard, "SLICE_BYTES", 20)
    compare_sets(ODD_WORDS)


@settings(max_examples=100, deadline=None)
@given(st.lists(st.none() | st.text(alphabet="aAbBzé \t\n\x0b\x1c\xa0\0日", max_size=30), min_size=1, max_size=6))
def test_sets_property(texts):
    compare_sets(texts)


def test_sets_call_no_function_for_each_word():
    """Twice the new words make no more calls; a call for each new word took most of the job's time."""
    import sys

    import pyarrow as pa

    def calls(words):
        count, texts = [0], [" ".join(f"w{t}x{k}" for k in range(words)) for t in range(10)]
        given_ = pa.record_batch([pa.array(range(10)), pa.array(texts), pa.array([0] * 10)], names=["doc_id", "text", "text_hash"])

        def counted(frame, event, arg):
            count[0] += event in ("call", "c_call")

        sys.setprofile(counted)
        try:
            list(jaccard._sign(iter([given_]), 5))
        finally:
            sys.setprofile(None)
        return count[0]

    calls(10)
    assert calls(2000) < calls(1000) + 100


# Line rules


def test_line_rules(docs, rows):
    def plain(doc_id, text):
        words = brute.BLANK.findall(text or "")
        seen, cover = Counter(zip(words, words[1:], words[2:])), set()
        for k in range(len(words) - 2):
            if seen[tuple(words[k : k + 3])] > 1:
                cover |= {k, k + 1, k + 2}
        lines = [x for x in (text or "").split("\n") if brute.BLANK.search(x)]
        return doc_id, len(words), sum(map(len, words)), len(re.findall("[#*$%&|<>]", text or "")), len(lines) - len(set(lines)), len(cover), len(words) < 50 or 100 * len(cover) > 50 * len(words)

    got = linerules.judged(docs).select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed").collect()
    same(got, [plain(*r) for r in rows])


def test_line_verdicts(spark):
    good = "\n".join(" ".join(f"Word{k}x{j} and other{k}y{j}" for j in range(9)) + ", I hope." for k in range(8))
    bad = ["HERE!! ALL!! WORDS!! ARE!! LOUD!! " * 15 + str(k) for k in range(3)]
    texts = [good, good + "\nHome\n© 2020 All rights reserved\n" + "a | b | c | d", "\n".join(bad), "\n".join(f"cell{k} | cell | other{k} | more{k * k}" for k in range(30)), "word%%% other### third&&& " * 20 + "end", None, "short"]
    got = linerules.judged(spark.createDataFrame(list(enumerate(texts)), "doc_id int, text string")).collect()
    assert [r["kept"] for r in sorted(got)] == [True, True, False, False, False, False, False]


# Host reputation


def test_hosts(spark):
    urls = [None, "no scheme", "http://A.Example.org/es/1?x", "https://example.org/en/12", "x://org/", "x://org", "http://b.com/fr/#f", "http://b.com/de/3", "http://b.net:80?q=/a", "a://b://c", "http://b.net/en/7.html", "http://xexample.org/es/"]
    pages = spark.createDataFrame([(k, u, "h", 1) for k, u in enumerate(urls)], "page_id long, url string, host string, rule int")
    labels = spark.createDataFrame([(7, 0, 0), (7, 1, 1), (None, 1, 1), (1, None, None)], "doc_id long, quality int, toxic int")
    got = {r["page_id"]: tuple(r)[1:] for r in hostrep.judge(pages, labels).collect()}
    assert {k: v[:3] for k, v in got.items()} == {
        0: ("", "", None), 1: ("", "", None), 2: ("a.example.org", "/es/1", "example.org/es/"), 3: ("example.org", "/en/12", "example.org/en/1"), 4: ("org", "/", "org/"), 5: ("org", "", None),
        6: ("b.com", "/fr/", "com/fr/"), 7: ("b.com", "/de/3", "com/de/"), 8: ("b.net:80", "", None), 9: ("b:", "//c", None), 10: ("b.net", "/en/7.html", None), 11: ("xexample.org", "/es/", "org/")}
    assert [got[k][3] for k in (2, 3, 4, 6, 7, 11)] == ["block", "block", "allow", "allow", "block", "allow"]
    assert hostrep.judge(pages.limit(0), labels).count() == 0 and hostrep.judge(pages, labels.limit(0)).where("rule is null and verdict = 'block'").count() == 0


def test_bad_host_is_blocked_and_small_one_shrunk(spark):
    urls = [f"http://bad{k % 3}.site{k % 4}.net/en/{k}" for k in range(120)] + [f"http://good{k % 9}.site{k % 4}.net/en/{k}" for k in range(120, 900)] + ["http://tiny.site1.net/en/5000"]
    pages = spark.createDataFrame(list(enumerate(urls)), "page_id long, url string")
    labels = spark.createDataFrame([(k, int(k >= 120), 0) for k in range(900)] + [(5000, 0, 0)], "doc_id long, quality int, toxic int")
    got = {r["host"]: r["verdict"] for r in hostrep.judge(pages, labels).collect()}
    assert {v for h, v in got.items() if h.startswith("bad")} == {"block"} and {v for h, v in got.items() if h[0] in "gt"} == {"allow"}


# Pages

NAV = "<nav><a href='/'>Home</a> <a>News</a></nav>"
PLAIN = """<!DOCTYPE html><html><head><title>T</title><style>p{}</style><script>var a="</p><p>x";</script></head><body>{nav}<!-- c --><div class="ad">Buy</div>
<article><h1>Head &amp; line</h1><p><b>First  part<br><p>Second&nbsp;one <a href=x>link</a>, &lt;ok&gt;</p><p>Third<form><input>Send</form><div class="comments"><p>I say</p></div></article>
<aside>More</aside><footer>&copy; me</footer>"""


def test_page_blocks():
    page = PLAIN.replace("{nav}", NAV)
    assert mainhtml.keep([mainhtml.blocks(page)], [0]) == ["Head & line\n\nFirst part\n\nSecond one link, <ok>\n\nThird"]
    assert [mainhtml.blocks(x) for x in (None, "", "<p>", "<script>x", "<!-- x")] == [[]] * 5
    assert mainhtml.keep([mainhtml.blocks("just < text")], [0]) == ["just < text"]


def test_repeated_runs_go_where_structure_is_silent():
    frame = "Welcome to our little site where you can find all sorts of things"
    pages = [f"<body><div>{frame}</div><div>Story {k} tells of {k * 7} and {k * 11} things that only page {k} has to tell</div><div>{frame} again</div></body>" for k in range(5)]
    got = mainhtml.keep([mainhtml.blocks(p) for p in pages], list(range(5)))
    assert got == [f"Story {k} tells of {k * 7} and {k * 11} things that only page {k} has to tell" for k in range(5)]
    assert mainhtml.keep([mainhtml.blocks(pages[0])] * 2, [0, 1])[0]  # copies keep something
    assert mainhtml.keep([mainhtml.blocks(pages[0])] * 2, [4, 4])[0].count(frame) == 2  # one page twice is not repeated


def told(name, n):
    return " ".join(f"{name}{k}" for k in range(n))


def test_covered_runs_are_cut_and_unique_runs_stay():
    quote, frame, story = told("quote", 55), told("frame", 30), told("story", 60)
    pages = [f"<body><div>{frame}</div><div>{told(f'own{k}x', 45)} {quote if k < 5 else ''}</div></body>" for k in range(8)]
    got = mainhtml.keep([mainhtml.blocks(p) for p in pages], list(range(8)))
    assert got == [told(f"own{k}x", 45) for k in range(8)]
    pages = [f"<body><div>{frame}</div><div>{story if k < 3 else told(f'own{k}x', 60)}</div><p>By Author {k}</p></body>" for k in range(20)]
    got = mainhtml.keep([mainhtml.blocks(p) for p in pages], list(range(20)))
    assert got == [f"{story if k < 3 else told(f'own{k}x', 60)}\n\nBy Author {k}" for k in range(20)]


def test_repeats_judge_the_article_and_guessed_furniture():
    notice, frame = told("notice", 50), told("menu", 20)
    pages = [f"<nav>{frame}</nav><article><p>{told(f'own{k}x', 40)}</p><p>{notice}</p><p>Short line</p></article><div class='promo'>{told(f'more{k}x', 60)}</div><div class='promo'>Buy {k}</div><div class='comments'>{told(f'said{k}x', 60)}</div>" for k in range(12)]
    assert mainhtml.keep([mainhtml.blocks(p) for p in pages], list(range(12))) == [f"{told(f'own{k}x', 40)}\n\nShort line\n\n{told(f'more{k}x', 60)}" for k in range(12)]
    for start, end in (("<form>", "</form>"), ("<div class='has-sidebar'>", "</div>"), ("<article class='card'>", "</article>")):
        page = f"<body><nav>{frame}</nav>{start}<p>A story</p><p>{told('word', 60)}</p>{end}</body>"
        assert mainhtml.keep([mainhtml.blocks(page)], [0]) == [f"A story\n\n{told('word', 60)}"]


@settings(max_examples=80, deadline=None)
@given(st.lists(st.lists(st.sampled_from("abc"), max_size=12), min_size=1, max_size=5))
def test_suffix_array_finds_what_brute_force_finds(streams):
    got = mainhtml.covered(streams, list(range(len(streams))), depth=3)
    holders = defaultdict(set)
    for k, s in enumerate(streams):
        for at in range(len(s) - 2):
            holders[tuple(s[at : at + 3])].add(k)
    for s, counts in zip(streams, got):
        want = [max((len(holders[tuple(s[b : b + 3])]) for b in range(max(0, p - 2), p + 1) if b + 3 <= len(s) and len(holders[tuple(s[b : b + 3])]) > 1), default=0) for p in range(len(s))]
        assert counts.tolist() == want


def test_extract(spark, monkeypatch):
    monkeypatch.setattr(mainhtml, "SHARD_BYTES", 2000)
    page = PLAIN.replace("{nav}", NAV)
    given_ = [(k, f"http://hot.example/{k}", page) for k in range(30)] + [(1, None, None), (None, "http://b.example/", ""), (2, "http://c.example/", "<p>x " * 40_000), (2, "http://c.example/", "<p>x " * 40_000)]
    df = spark.createDataFrame([(*r, "clash", 1) for r in given_], "page_id long, url string, html string, host string, shard int")
    got = mainhtml.extract(df).collect()
    assert len(got) == 34 and {r["text"] for r in got if r["url"] and "hot" in r["url"]} == {"Head & line\n\nFirst part\n\nSecond one link, <ok>\n\nThird"}
    assert all(r["n_chars"] == len(r["text"]) for r in got) and [r["text"] for r in got if r["url"] is None or "//b" in r["url"]] == ["", ""]
    assert mainhtml.extract(df.limit(0)).count() == 0


def test_shards_do_not_change_results(spark, monkeypatch):
    banner, notice = told("banner", 12), told("notice", 40)
    given_ = [(k, f"http://hot.example/{k}", f"<div>{banner if k % 4 == 0 else told(f'side{k}x', 5)}</div><div>{told(f'own{k}x', 50)}{' ' + notice if k % 5 == 0 else ''}</div>") for k in range(60)] + [(3, "http://cold.example/", f"<div>{banner}</div>")]
    df = spark.createDataFrame(given_ + given_[:2], "page_id long, url string, html string")
    whole = mainhtml.extract(df).collect()
    assert all("banner" not in r["text"] and "notice" not in r["text"] for r in whole if "hot" in r["url"]) and len(whole) == 63
    monkeypatch.setattr(mainhtml, "SHARD_BYTES", 900)
    same(mainhtml.extract(df).collect(), whole)


# Personal data

PATTERNS = {"email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", "card": r"[0-9]([\x20-]?[0-9])+", "phone": r"\+[0-9][\x20().0-9-]+[0-9]"}


def luhn(digits):
    return sum(int(c) if k % 2 == 0 else 2 * int(c) - 9 * (c > "4") for k, c in enumerate(reversed(digits))) % 10 == 0


def plain_spans(text):
    out = []
    for kind, pattern in PATTERNS.items():
        for m in re.finditer(pattern, text or ""):
            digits = re.sub("[^0-9]", "", m[0])
            if {"email": True, "ip": kind != "ip" or all(int(x) <= 255 for x in m[0].split(".")), "card": 12 <= len(digits) <= 19 and luhn(digits), "phone": 9 <= len(digits) <= 15}[kind]:
                out.append((m.start(), list(PATTERNS).index(kind), m.end()))
    return sorted(out)


def test_base_spans(spark):
    import random

    pick = random.Random(5)
    texts = ["".join(pick.choices("ab@.-_%+ 0123456789()é日", k=pick.choice((5, 20, 60)))) for _ in range(300)]
    texts += ["a@b.c_d@e.f", "1.2.3.4.5.6.7.8 256.1.1.1 01.002.0003.4", "4111 1111-1111 1111 4111111111111112 79927398713", "+1 (743) 555-3824 +1+2 345 678 901.", "x" * 200_000 + "@", "1" * 100_000, "1 " * 100_000 + "@a.b", "a@" + "b." * 50_000 + "c", None, "", "é日 me@x.org"]
    got = pii.spans_of(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")).collect()
    for r in got:
        base = [tuple(s) for s in r["base"]]
        assert base == plain_spans(texts[r["doc_id"]]), texts[r["doc_id"]][:80]
        assert set(base) <= {tuple(s) for s in r["spans"]}


def test_redact(spark, docs, no_docs):
    given_ = [(k, f"Call me at +1 (743) 555-38{k:02d} or write to me{k}@mail.example.org today") for k in range(30)] + [(99, None), (98, "clean text of 2020"), (97, "card 4111111111111111, card 4111111111111113 x"), (97, "card 4111111111111111, card 4111111111111113 x")]
    df = spark.createDataFrame([(i, t, "c", 1) for i, t in given_], "doc_id long, text string, spans string, kind int")
    got = pii.redact(df)
    assert got.columns == df.columns
    texts = defaultdict(list)
    for r in got.collect():
        texts[r["doc_id"]].append(r["text"])
    assert texts[3] == ["Call me at [PHONE] or write to [EMAIL] today"] and texts[99] == [None] and texts[98] == ["clean text of 2020"]
    assert len(texts[97]) == 2 and all(t.startswith("card [CARD], card ") for t in texts[97])
    assert pii.redact(no_docs).count() == 0 and pii.redact(docs).count() == docs.count()


@pytest.mark.parametrize("n", [20, 2000])
def test_other_forms_are_found_at_every_size(spark, n):
    given_ = [(k, f"Write to me{k}@mail.example.org or to you{k} [at] mail{k} [dot] com, host 10[.]2[.]{k % 250}[.]4 is up, so is 2001:db8:0:0:0:0:0:{k % 999}") for k in range(n)]
    texts = {r["text"] for r in pii.redact(spark.createDataFrame(given_, "doc_id long, text string")).collect()}
    assert texts == {"Write to [EMAIL] or to [EMAIL], host [IP] is up, so is [IP]"}


# Scores


def test_toxicity(spark):
    plain = "this is a harmless line of words that says nothing bad number"
    given_ = [(k, f"{plain} {k} " + ("you zorkel and zorkelung" if k % 3 == 0 else "you friend")) for k in range(150)]
    extra = [(1000, "ZORKEL!"), (1001, "z0rkel you"), (1002, "zоrkel"), (1003, plain), (1004, ""), (1005, None), (None, "zorkel")]
    docs = spark.createDataFrame([(i, t, 0.5) for i, t in given_ + extra], "doc_id long, text string, score double")
    labels = spark.createDataFrame([(k, int(k % 3 == 0)) for k in range(150)] + [(None, 1), (5, None)], "doc_id long, toxic int")
    lexicon = toxicity.learn(docs, labels)
    got = toxicity.toxicity_scores(docs, lexicon).collect()
    score = {r["doc_id"]: r["score"] for r in got}
    assert all(score[k] > 0.5 for k in (1000, 1001, 1002, None, 0)) and all(score[k] < 0.3 for k in (1003, 1004, 1005, 1))
    assert all(r["held_out"] == brute.held_out(r["doc_id"]) for r in got)
    kept = toxicity.drop_toxic(docs, lexicon)
    assert kept.columns == docs.columns and {r["doc_id"] for r in kept.collect()} == {i for i, s in score.items() if s < 0.3}
    blank = toxicity.learn(docs, labels.limit(0))
    assert {r["score"] for r in toxicity.toxicity_scores(docs, blank).collect()} == {0.5}


def test_exceptions_do_not_count():
    lexicon = toxicity.Lexicon({" trash ": 3.0}, curve=(-2.0, 3.0, 1.0))
    own = lexicon.automaton()
    assert lexicon.features("take out the trash can now", own) == (0.0, 0.0) and lexicon.features("you trash", own)[1] > 0


def test_quality(spark, docs):
    good = "A plain sentence with some words in it, as people write them. Another one follows here."
    given_ = [(k, good + f" Number {k} ends it." if k % 4 else f"BUY!! NOW!! {k}%%% ###" * 8) for k in range(300)] + [(900, ""), (901, None), (None, good)]
    df = spark.createDataFrame(given_, "doc_id long, text string")
    labels = spark.createDataFrame([(k, int(k % 4 > 0)) for k in range(300)], "doc_id long, quality int")
    got = quality.quality_scores(df, labels).collect()
    held = [r for r in got if r["held_out"] and r["doc_id"] is not None and r["doc_id"] < 300]
    assert held and all((r["score"] >= 0.7) == (r["doc_id"] % 4 > 0) for r in held) and len(got) == 303
    assert {r["score"] for r in quality.quality_scores(docs, labels.limit(0)).collect()} == {0.5}
    assert quality.quality_scores(docs.limit(0), labels).count() == 0


def test_trees_separate_what_one_cut_cannot():
    pick = np.random.default_rng(1)
    rows = pick.random((2000, 3))
    labels = ((rows[:, 0] > 0.5) ^ (rows[:, 1] > 0.5)).astype(float)
    model = quality.fit(rows[:1500], labels[:1500])
    assert ((model.score(rows[1500:]) > 0.5) == (labels[1500:] > 0.5)).mean() > 0.95
    assert model.score(np.zeros((0, 3))).shape == (0,)


def test_components_of_paths_stars_and_rings(spark):
    edges = [(k, k + 1) for k in range(25)] + [(100, k) for k in range(101, 130)] + [(200 + k, 200 + (k + 1) % 9) for k in range(9)] + [(7, 3), (300, 300)]
    got = {r["node"]: r["root"] for r in jaccard.components(spark.createDataFrame(edges, "a long, b long")).collect()}
    want = {**dict.fromkeys(range(26), 0), **dict.fromkeys(range(100, 130), 100), **dict.fromkeys(range(200, 209), 200)}
    assert got == want
    assert jaccard.components(spark.createDataFrame([], "a long, b long")).count() == 0


# Chats


def test_chats(spark):
    text = "System: You are kind.\nUser: Hi\nHow are you?\n### Assistant\nFine.\n\nThanks: a lot\n<|im_start|>user\nBye<|im_end|>"
    given_ = [(1, 0, None, text, "c"), (1, 0, None, text, "c"), (1, 1, "user", None, "c"), (None, None, "odd", " \n", "c"), (2, 1, "assistant", "A plain line.", "c"), (3, 0, "user", "What?", "c"), (4, 2, "odd", "x\n" * 20_000, "c")]
    df = spark.createDataFrame(given_, "conv_id long, turn long, role string, text string, rendered string")
    got = chat.format_chats(df).collect()
    first = [r for r in got if r["conv_id"] == 1 and r["turn"] == 0]
    assert len(got) == 7 and len(first) == 2 and first[0] == first[1]
    assert first[0]["roles"] == "system,user,assistant,user" and first[0]["rendered"].startswith("<|system|>\nYou are kind.\n<|end|>\n<|user|>\nHi\nHow are you?\n<|end|>\n<|assistant|>\nFine.")
    assert {(r["conv_id"], r["rendered"], r["n_turns"]) for r in got if not r["n_turns"]} == {(1, "", 0), (None, "", 0)}
    assert chat.format_chats(df.limit(0)).count() == 0


def test_viterbi_is_the_best_path():
    from itertools import product

    chances = {f: np.log(v) for f, v in {"length2": np.array([0.1, 0.6, 0.2, 0.1]), "length1": np.array([0.1, 0.2, 0.6, 0.1]), "open": np.array([0.3, 0.2, 0.4, 0.1])}.items()}
    for lines in product(("a", "bc", "User: bc", "bot: a"), repeat=4):
        turns = chat.viterbi("\n".join(lines), 0, chances)
        best = None
        for path in product(range(4), repeat=4):
            total = 0.0
            for at, (line, role) in enumerate(zip(lines, path)):
                mark, rest = chat.marker(line)
                total += sum(chances[f][role] for f in chat.features(rest, 0, at == 0) if f in chances)
                if mark:
                    total += np.log(chat.TRUE_MARK if chat.ROLES[role] == mark else (1 - chat.TRUE_MARK) / 3)
                if at:
                    total += -np.log(4) if mark else np.log(chat.STAY if path[at - 1] == role else (1 - chat.STAY) / 3)
            best = max(best or (-1e9, ()), (total, path))
        want = [chat.ROLES[r] for at, r in enumerate(best[1]) if not at or r != best[1][at - 1] or chat.marker(lines[at])[0]]
        assert [r for r, _ in turns] == want


def test_roles_come_from_the_whole_conversation(spark, monkeypatch):
    """Lines that look alike are told apart by their neighbours, however a conversation is cut into chunks."""
    given_ = [(c, t, ("user", "assistant")[t % 2], f"Line {t}." if t else "Who is it?") for c in range(12) for t in range(8)]
    given_ += [(99, t, ("user", "assistant")[t % 2], "Same." if t else "Who is it?") for t in range(60)]
    given_ += [(99, 7, "user", "Same."), (None, 1, "user", "Same."), (None, 1, "user", "Same."), (98, None, None, None), (98, 1, "odd", "Same.")]
    df = spark.createDataFrame(given_, "conv_id long, turn long, role string, text string").repartition(3)
    whole = chat.format_chats(df).collect()
    assert len(whole) == len(given_) and all(r["roles"] == r["role"] for r in whole if r["conv_id"] is not None and r["conv_id"] < 98)
    assert len({r["roles"] for r in whole if (r["conv_id"], r["turn"]) == (99, 7)}) == 1
    monkeypatch.setattr(chat, "CHUNK_TURNS", 3)
    same(chat.format_chats(df).collect(), whole)
    pieces = sorted((r["piece"], r["rendered"]) for r in chat.conversations(df).where("conv_id = 99").collect())
    assert len(pieces) > 19 and [p for p, _ in pieces] == list(range(len(pieces)))
    seen = {r["turn"]: r["rendered"] for r in whole if r["conv_id"] == 99}
    assert "".join(t for _, t in pieces) == "".join(seen[t] for t in sorted(seen))
    assert chat.conversations(df.where("conv_id is null")).count() == 2 and chat.conversations(df.limit(0)).count() == 0
