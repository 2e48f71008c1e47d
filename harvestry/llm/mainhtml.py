"""Main text of web pages: structure proposes blocks, host suffix arrays find the boilerplate among them.

Method. Each page becomes a stream of text blocks. Structure is one input: scripts, menus, footers, hidden text and comments go; blocks of the
article element, guessed furniture (forms, class words, all outside an article) and open blocks are judged by their repeats. The token streams of a host's blocks are then laid end to end, with a mark of its own between blocks, and their
suffixes are sorted by prefix doubling to a depth of ``MIN_RUN`` tokens. Neighbours that agree to that depth and lie on distinct pages make a
long repeated substring; a shorter block is one as a whole. A substring on ``frame_pages`` of the host's pages or more is frame: its tokens are cut
out of blocks that structure left open, and the unique runs of each block stay. Inside the article only frames of more pages, of ``LONG_RUN`` tokens or more,
go, and between the article's own blocks only those of half the host's pages; of guessed furniture unique runs of ``FURNITURE_RUN`` tokens stay, and a guess over four fifths of a page is dropped. If that would leave nothing of a page, its least repeated blocks
stay; if it would leave less than two windows, the blocks that are at most half as often repeated as the page's frame do, since the page then is
a copy.

Hosts are cut into shards of about ``SHARD_BYTES`` of html by page id, so that one host may hold any share of all pages. What repeats is counted
over the whole host: each shard counts its windows of ``MIN_RUN`` tokens (hashes of 48 bits taken as equal when they agree), (host, hash range)
sums the distinct pages of all shards, and each shard gets back those of its windows that may be frame. Pages of such hosts cross the network
twice, compressed; all others once.

Defined results: a null or empty page has the empty text, and so has one without blocks. Null urls form a host of their own. Repeated rows
each get their row and do not count as distinct pages where their page id and url agree. Other columns are ignored.
"""

from __future__ import annotations

import html as entities
import re
from collections.abc import Iterator
from hashlib import blake2b

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from harvestry.llm.common import stored

MIN_RUN = 8
#: A run is frame from this share of a host's distinct pages, but at least from so many. Shares alone decide, so a host that grows keeps the same blocks.
FRAME_PERCENT, LEAST_FRAME_PAGES = 2, 3
#: The same inside the article, where copied sentences are likelier: at its borders, and between its own blocks.
ARTICLE_PERCENT, MIDDLE_PERCENT, LEAST_ARTICLE_PAGES = 10, 50, 10
#: Frames inside the article go from this length, since shorter sentences are repeated by nature; unique runs of guessed furniture stay from that length.
LONG_RUN, FURNITURE_RUN = 24, 50
#: Fills blocks of fewer tokens than a window.
END = "\n"
SHARD_BYTES = 16_000_000
#: Hosts of more than one shard that may be broadcast.
MOST_BROADCAST = 50_000
HOST = r"^[^:]*://([^/?#]*)"

# Elements and the words in class, id and role that mark what is not main text.
RAW = ("script", "style", "noscript", "template", "textarea", "title", "iframe", "svg", "select", "object", "canvas", "video", "audio")
FURNITURE_TAGS = {"nav", "aside", "footer", "form", "button", "menu", "dialog", "head", "label", "fieldset"}
INLINE = {"a", "abbr", "b", "bdi", "bdo", "big", "br", "cite", "code", "data", "del", "dfn", "em", "font", "i", "img", "ins", "kbd", "mark", "q", "rp", "rt", "ruby", "s", "samp", "small",
          "span", "strike", "strong", "sub", "sup", "time", "tt", "u", "var", "wbr"}
VOID = {"area", "base", "br", "col", "embed", "hr", "img", "input", "link", "meta", "param", "source", "track", "wbr"}
FURNITURE_WORDS = set("ad ads advert adverts advertisement advertising banner breadcrumb breadcrumbs comment comments consent cookie cookies copyright disqus footer gdpr header login masthead menu modal nav navbar "
                      "navigation newsletter notice notification pager pagination popup promo promoted related replies reply rss search share sharing sidebar signup skip social sponsor sponsored subscribe tags toolbar "
                      "widget complementary contentinfo alert alertdialog dialog".split())
#: Tags and words that only hint at furniture, and words of others' text, which is unique by nature.
GUESSED_TAGS = {"form", "fieldset", "label"}
COMMENT_WORDS = {"comment", "comments", "reply", "replies", "disqus"}
CARD_WORDS = {"comment", "comments", "reply", "replies", "related", "promo", "ad", "ads", "advert", "sponsored", "teaser", "card"}
CONTENT_WORDS = {"article", "content", "main", "post", "entry", "story", "body", "text"}

TOKEN = re.compile(r"<!--.*?(?:-->|\Z)|<!\[CDATA\[.*?(?:\]\]>|\Z)|<(" + "|".join(RAW) + r")\b[^>]*>.*?(?:</\1\s*[^>]*>|\Z)|<(/?)([a-zA-Z][a-zA-Z0-9:-]*)((?:[^>\"']|\"[^\"]*\"|'[^']*')*)>|<[!?][^>]*>|([^<]+|<)", re.S | re.I)
ATTRIBUTE = re.compile(r"""(class|id|role|hidden|aria-hidden|style)(?:\s*=\s*("[^"]*"|'[^']*'|[^\s"'>]+))?(?=[\s/]|\Z)""", re.I)
NOT_LETTERS = re.compile(r"[^a-z]+")


def _element(tag: str, attributes: str, in_article: bool) -> tuple[int, int]:
    """Whether an element holds furniture (2 surely, 1 as a guess, 0 not); and how surely it holds the article (3 article, 2 main, 1 by its name)."""
    marks, hidden = set(), False
    for name, value in ATTRIBUTE.findall(attributes) if attributes else ():
        name, value = name.lower(), value.strip("\"'").lower()
        hidden |= name == "hidden" or name == "aria-hidden" and value == "true" or name == "style" and re.search(r"display\s*:\s*none", value) is not None
        marks.update(NOT_LETTERS.split(value) if name in ("class", "id", "role") else ())
    if tag in ("body", "html"):
        return 0, 0
    others = 2 if hidden or marks & COMMENT_WORDS else 0
    if tag in ("article", "main") or "main" in marks and "role" in attributes.lower():
        return others or int(bool(marks & CARD_WORDS)), 3 if tag == "article" else 2
    if tag in FURNITURE_TAGS or hidden or tag == "header" and not in_article:
        return others or (1 if tag in GUESSED_TAGS else 2), 0
    sure = 1 if tag in ("div", "section", "td") and marks & CONTENT_WORDS else 0
    return (others or 1 if marks & FURNITURE_WORDS and not sure and not (in_article and tag == "header") else 0), sure


def blocks(page: str | None) -> list[tuple[str, str]]:
    """``(kind, text)`` in page order; kind A is main text, F furniture, G furniture by a guess, U open."""
    out: list[list] = []  # furniture, level, text, share of link characters
    stack: list[tuple[str, int, int]] = []  # tag, furniture, level: both with those above
    parts: list[str] = []
    linked = links = 0

    def close() -> None:
        nonlocal linked
        if parts and (text := " ".join(entities.unescape("".join(parts)).split())):
            _, furniture, level = stack[-1] if stack else ("", 0, 0)
            out.append([furniture, level, text, linked / max(1, sum(map(len, parts)))])
        parts.clear()
        linked = 0

    for m in TOKEN.finditer(page or ""):
        raw, end, tag, attributes, text = m.groups()
        if text is not None:
            parts.append(text)
            linked += len(text) if links else 0
        elif tag is None:
            if raw is not None:
                parts.append(" ")
        else:
            tag = tag.lower()
            if tag == "a":
                links = 0 if end else 1
            if tag in INLINE:
                if tag == "br":
                    parts.append(" ")
                if not attributes or "hidden" not in attributes and "none" not in attributes:
                    continue
            close()
            if end:
                at = next((k for k in range(len(stack) - 1, -1, -1) if stack[k][0] == tag), None)
                if at is not None:
                    del stack[at:]
            elif tag not in VOID and not attributes.endswith("/"):
                if tag == "p" and stack and stack[-1][0] == "p":
                    stack.pop()
                _, furniture, level = stack[-1] if stack else ("", 0, 0)
                own, sure = _element(tag, attributes, level == 3)
                stack.append((tag, max(furniture, own), max(level, sure)))
    close()
    size = [sum(len(text) for furniture, _, text, _ in out if furniture == guess) for guess in (0, 1)]
    if size[1] > 4 * size[0]:  # a guess that takes nearly all of a page is none
        out = [[0, 0, text, share] if furniture == 1 else [furniture, 0, text, share] for furniture, level, text, share in out]
    best = max((level for furniture, level, *_ in out if not furniture), default=0)
    return [("F" if furniture == 2 else "G" if furniture or best >= 2 and level < best else "U" if level < best or best == 0 or share > 0.5 else "A", text) for furniture, level, text, share in out]


def _pages(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    press = zstandard.ZstdCompressor(level=3)
    for batch in batches:
        for at in range(0, batch.num_rows, 500):
            part = batch.slice(at, 500)
            packed = [press.compress("\n".join(k + t for k, t in blocks(p)).encode("utf-8", "surrogatepass")) for p in part.column("html").to_pylist()]
            yield pa.record_batch([*(part.column(c) for c in ("page_id", "url", "host", "shard", "shards")), pa.array(packed, pa.binary())], names=["page_id", "url", "host", "shard", "shards", "packed"])


def _held(streams: list[list[str]], owners: list[int], depth: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Over all streams laid end to end, how many distinct owners hold the ``depth`` tokens that begin there; and where streams begin, and their sizes with a mark.

    The suffix array of all streams is sorted to ``depth`` tokens: ranks of 1, 2, 4, ... tokens, each from two of the half before.
    """
    sizes = np.array([len(s) + 1 for s in streams], np.int64)
    first, known = np.cumsum(sizes) - sizes, {}
    rank, owner = np.zeros(int(sizes.sum()), np.int64), np.repeat(np.array(owners, np.int64), sizes)
    for k, (at, stream) in enumerate(zip(first, streams)):
        rank[at : at + len(stream)] = [known.setdefault(w, len(known)) for w in stream]
        rank[at + len(stream)] = -1 - k  # ends the stream and is like no other token
    done = 1
    while done < depth and len(rank):
        step = min(done, depth - done)
        after = np.concatenate([rank[step:], np.full(min(step, len(rank)), -1 - len(streams))])[: len(rank)]
        low = min(int(rank.min()), int(after.min()))
        _, rank = np.unique((rank - low) * (int(after.max()) - low + 1) + (after - low), return_inverse=True)
        done += step
    if not len(rank):
        return np.zeros(0, np.int64), first, sizes
    order = np.lexsort((owner, rank))  # the suffix array: neighbours of one rank agree to the full depth
    ranks, owners_ = rank[order], owner[order]
    fresh = np.ones(len(order), bool)
    fresh[1:] = (ranks[1:] != ranks[:-1]) | (owners_[1:] != owners_[:-1])
    return np.bincount(ranks[fresh], minlength=int(ranks[-1]) + 1)[rank], first, sizes


def _spread(held: np.ndarray, first: np.ndarray, sizes: np.ndarray, depth: int) -> list[np.ndarray]:
    """Per stream, the most owners of any window over each token; 0 for windows of one owner."""
    out, count = np.zeros(len(held), np.int64), np.where(held >= 2, held, 0)
    for shift in range(min(depth, len(out))):  # each repeated window covers its tokens
        out[shift:] = np.maximum(out[shift:], count[: len(count) - shift])
    return [out[a : a + n - 1] for a, n in zip(first, sizes)]


def covered(streams: list[list[str]], owners: list[int], depth: int = MIN_RUN) -> list[np.ndarray]:
    """Per stream, how many distinct owners hold a repeated substring over each token; 0 for unique runs."""
    return _spread(*_held(streams, owners, depth), depth)


def _streams(pages: list[list[tuple[str, str]]], owners: list[int]) -> tuple[list[list[str]], list[int]]:
    """Tokens of every block, filled up to a window's length, and whose they are."""
    streams = [(w := text.split(" ")) + [END] * (MIN_RUN - len(w)) for page in pages for _, text in page]
    return streams, [o for page, o in zip(pages, owners) for _ in page]


def frame_pages(n_pages: int, kind: str = "U") -> int:
    """From how many distinct pages a run belongs to the host's frame, in blocks of a kind."""
    if kind in "AM":
        return max(LEAST_ARTICLE_PAGES, -(-n_pages * (ARTICLE_PERCENT if kind == "A" else MIDDLE_PERCENT) // 100))
    return max(LEAST_FRAME_PAGES, -(-n_pages * FRAME_PERCENT // 100))


def _bordering(kinds: list[str], stay: list[np.ndarray]) -> set[int]:
    """Article blocks at its borders: the first and last one, and those next to a bordering block that goes as a whole."""
    own, found = [k for k, kind in enumerate(kinds) if kind == "A"], set()
    for order in (own, own[::-1]):
        for k in order:
            found.add(k)
            if stay[k].any():
                break
    return found


def _runs(over: np.ndarray) -> Iterator[tuple[int, int]]:
    """Borders of the runs of true values."""
    edges = np.flatnonzero(np.diff(np.concatenate([[False], over, [False]]).astype(np.int8)))
    return zip(edges[::2].tolist(), edges[1::2].tolist())


def _unique(kind: str, over: np.ndarray) -> np.ndarray:
    """Which tokens of a block stay, by whether the host's frame covers them: inside the article long frames go, in guessed furniture long unique runs stay."""
    if kind == "U":
        return ~over
    stay = np.full(len(over), kind == "A")
    if kind == "A" and over.any():
        for a, b in _runs(over):
            stay[a:b] = b - a < LONG_RUN
    elif kind == "G" and len(over) >= FURNITURE_RUN:
        for a, b in _runs(~over):
            stay[a:b] = b - a >= FURNITURE_RUN
    return stay


def window_hashes(streams: list[list[str]]) -> np.ndarray:
    """Hash of 48 bits of the ``MIN_RUN`` tokens that begin at each place of all streams and their end marks; -1 where fewer are left."""
    known: dict[str, int] = {}
    own, whole = [], []
    for stream in streams:
        for w in stream:
            if w not in known:
                known[w] = int.from_bytes(blake2b(w.encode("utf-8", "surrogatepass"), digest_size=8).digest(), "little")
            own.append(known[w])
        own.append(0)
        whole += [True] * (len(stream) - MIN_RUN + 1) + [False] * MIN_RUN
    tokens, total = np.array(own, np.uint64), np.zeros(len(own), np.uint64)
    for k in range(min(MIN_RUN, len(own))):
        total = total * np.uint64(0x9E3779B97F4A7C15)
        total[: len(own) - k] += tokens[k:]
    total ^= total >> np.uint64(29)
    return np.where(np.array(whole, bool), (total * np.uint64(0xBF58476D1CE4E5B9) >> np.uint64(16)).astype(np.int64), -1)


def keep(pages: list[list[tuple[str, str]]], owners: list[int], n_pages: int | None = None, known: tuple[np.ndarray, np.ndarray] | None = None) -> list[str]:
    """Main text of each page of a shard; ``n_pages`` and ``known`` are the host's distinct pages, and its windows on several as (sorted hashes, distinct pages)."""
    words = [[text.split(" ") for _, text in page] for page in pages]
    streams, of = _streams(pages, owners)
    held, first, sizes = _held(streams, of, MIN_RUN)
    if known is not None and len(known[0]):
        hashes = window_hashes(streams)
        at = np.minimum(np.searchsorted(known[0], hashes), len(known[0]) - 1)
        held = np.maximum(held, np.where(known[0][at] == hashes, known[1][at], 0))
    found = iter(_spread(held, first, sizes, MIN_RUN))
    need, out = {kind: frame_pages(len(set(owners)) if n_pages is None else n_pages, kind) for kind in "AFGMU"}, []
    for page, split in zip(pages, words):
        counts = [next(found)[: len(b)] for b in split]
        stay = [_unique(kind, c >= need[kind]) for (kind, _), c in zip(page, counts)]
        border = _bordering([kind for kind, _ in page], stay)
        stay = [_unique(kind, c >= need["M"]) if kind == "A" and k not in border else x for k, ((kind, _), c, x) in enumerate(zip(page, counts, stay))]
        kept = sum(int(x.sum()) for x in stay)
        if kept < 2 * MIN_RUN:  # maybe a copy: its story is repeated, but less than the frame
            often = [float(np.median(c[c >= need[kind]])) if kind in "AU" and not x.any() and (c >= need[kind]).any() else None for (kind, _), c, x in zip(page, counts, stay)]
            least, most = min((x for x in often if x is not None), default=None), max((int(c.max()) for c in counts), default=0)
            if least is not None and (not kept or 2 * least <= most):
                stay = [np.ones(len(c), bool) if o is not None and o <= (most / 2 if kept else least) else x for c, o, x in zip(counts, often, stay)]
        texts = (text if x.all() else " ".join(w for w, ok in zip(b, x) if ok) for (_, text), b, x in zip(page, split, stay))
        out.append("\n\n".join(t for t in texts if t))
    return out


def _read(group: pa.Table) -> tuple[list[list[tuple[str, str]]], list[int]]:
    """Blocks and number of each page of a shard; rows that agree in page id and url have one number."""
    expand = zstandard.ZstdDecompressor()
    pages = [[(line[0], line[1:]) for line in expand.decompress(p).decode("utf-8", "surrogatepass").split("\n") if line] for p in group.column("packed").to_pylist()]
    same: dict = {}
    return pages, [same.setdefault(key, len(same)) for key in zip(group.column("page_id").to_pylist(), group.column("url").to_pylist())]


def _pack(hashes: np.ndarray, counts: np.ndarray) -> tuple[bytes, bytes]:
    press = zstandard.ZstdCompressor(level=3)
    return press.compress(np.diff(hashes, prepend=0).astype("<i8").view(np.uint8).reshape(-1, 8).T.tobytes()), press.compress(counts.astype("<i4").tobytes())


def _unpack(hashes: bytes, counts: bytes) -> tuple[np.ndarray, np.ndarray]:
    expand = zstandard.ZstdDecompressor()
    raw = np.frombuffer(expand.decompress(hashes), np.uint8).reshape(8, -1).T
    return np.ascontiguousarray(raw).view("<i8").ravel().cumsum(), np.frombuffer(expand.decompress(counts), "<i4").astype(np.int64)


WINDOWS = "host string, shard int, bucket int, pages long, hashes binary, counts binary"


def _table(rows: list[tuple]) -> pa.Table:
    columns = list(zip(*rows)) or [()] * 6
    types = (pa.string(), pa.int32(), pa.int32(), pa.int64(), pa.binary(), pa.binary())
    return pa.table([pa.array(c, t) for c, t in zip(columns, types)], names=["host", "shard", "bucket", "pages", "hashes", "counts"])


def _windows(group: pa.Table) -> pa.Table:
    """A shard's windows and on how many of its distinct pages they are, in as many buckets by hash as the host has shards."""
    pages, owners = _read(group)
    streams, of = _streams(pages, owners)
    hashes = window_hashes(streams)
    place = np.flatnonzero(hashes >= 0)
    owner = np.repeat(np.array(of, np.int64), [len(s) + 1 for s in streams])[place]
    own = hashes[place]
    order = np.lexsort((owner, own))
    own, owner = own[order], owner[order]
    fresh = np.ones(len(own), bool)
    fresh[1:] = (own[1:] != own[:-1]) | (owner[1:] != owner[:-1])
    found, counts = np.unique(own[fresh], return_counts=True)
    host, shard, buckets = (group.column(k)[0].as_py() for k in ("host", "shard", "shards"))
    edges = np.searchsorted(found, np.arange(buckets + 1, dtype=np.float64) * (2.0**48 / buckets))
    return _table([(host, shard, b, len(set(owners)), *_pack(found[edges[b] : edges[b + 1]], counts[edges[b] : edges[b + 1]])) for b in range(buckets)])


def _across(group: pa.Table) -> pa.Table:
    """To each shard, the windows of a bucket that it holds and that may be frame, with the host's distinct pages that hold them."""
    held = [_unpack(h, c) for h, c in zip(group.column("hashes").to_pylist(), group.column("counts").to_pylist())]
    pages = sum(group.column("pages").to_pylist())
    found, at = np.unique(np.concatenate([h for h, _ in held]), return_inverse=True)
    total = np.bincount(at, np.concatenate([c for _, c in held]), len(found)).astype(np.int64)
    often = total >= min(frame_pages(pages), frame_pages(pages, "A"))
    out, start = [], 0
    for (hashes, _), host, shard, bucket in zip(held, *(group.column(k).to_pylist() for k in ("host", "shard", "bucket"))):
        own = at[start : start + len(hashes)]
        own, start = own[often[own]], start + len(hashes)
        out.append((host, shard, bucket, pages, *_pack(found[own], total[own])))
    return _table(out)


def _shard(group: pa.Table) -> pa.Table:
    sent, known, n_pages = group.filter(pc.is_valid(group.column("hashes"))), None, None
    if sent.num_rows:
        group, n_pages = group.filter(pc.is_valid(group.column("packed"))), sent.column("pages")[0].as_py()
        each = [_unpack(*x) for _, *x in sorted(zip(*(sent.column(k).to_pylist() for k in ("bucket", "hashes", "counts"))))]
        known = np.concatenate([h for h, _ in each]), np.concatenate([c for _, c in each])
    texts = keep(*_read(group), n_pages, known)
    return pa.table([group.column("page_id"), group.column("url"), pa.array(texts, pa.string()), pa.array([len(t) for t in texts], pa.int64())], names=["page_id", "url", "text", "n_chars"])


def extract(pages: DataFrame) -> DataFrame:
    """Per row: ``page_id, url, text, n_chars``."""
    host = F.lower(F.regexp_extract(F.coalesce("url", F.lit("")), HOST, 1))
    narrow = pages.select(F.col("page_id").cast("long"), F.col("url").cast("string"), F.col("html").cast("string")).withColumn("host", host)
    large = stored(narrow.groupBy("host").agg(F.ceil(F.sum(F.coalesce(F.length("html"), F.lit(0)).cast("long")) / SHARD_BYTES).cast("int").alias("shards")).where("shards > 1"), "large_hosts")
    n_large = large.count()
    large = F.broadcast(large) if n_large <= MOST_BROADCAST else large  # beyond that, pages meet it by a shuffle
    shards = F.coalesce("shards", F.lit(1))
    dealt = narrow.join(large, "host", "left").withColumn("shard", F.pmod(F.xxhash64("page_id", "url"), shards).cast("int")).select("page_id", "url", "host", "shard", shards.alias("shards"), "html")
    form = "page_id long, url string, host string, shard int, shards int, packed binary"
    whole = (dealt.where("shards = 1") if n_large else dealt).mapInArrow(_pages, form).withColumns({"bucket": F.lit(None).cast("int"), "pages": F.lit(None).cast("long"), "hashes": F.lit(None).cast("binary"), "counts": F.lit(None).cast("binary")})
    if n_large:
        # Pages of large hosts are parsed twice, to count windows across shards and to decide: that takes less disk than to store their blocks.
        cut = dealt.where("shards > 1").mapInArrow(_pages, form)
        counted = cut.groupBy("host", "shard").applyInArrow(_windows, WINDOWS)
        sent = counted.groupBy("host", "bucket").applyInArrow(_across, WINDOWS)
        whole = whole.unionByName(cut, allowMissingColumns=True).unionByName(sent, allowMissingColumns=True)
    return whole.groupBy("host", "shard").applyInArrow(_shard, "page_id long, url string, text string, n_chars long")
