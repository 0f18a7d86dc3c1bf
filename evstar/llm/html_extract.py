"""Main text of web pages, with a suffix array per host.

Markup gives each block of text a zone: inside the article, beside it (menus,
footers, adverts, ...), or neutral. The token streams of a host's pages,
apart from their articles, are concatenated and put into a suffix array;
substrings of at least ``MIN_TOKENS`` tokens that occur on ``MIN_PAGES``
distinct pages are boilerplate. A page without an article keeps the unique
runs of its neutral blocks.

The boxes within articles (their inner ``div`` and ``section`` elements) make
streams of another suffix array, in which pages with the same article count
once. A box that lies in repeated substrings as a whole goes, unless half of
the article does (a copied article). Articles that follow the page's own in an
element of a kind that follows it on ``MIN_PAGES`` pages are comments and go.

No task holds a host of over ``PAGES_PER_SHARD`` pages: its runs of
``MIN_TOKENS`` tokens are counted by distinct pages over the whole host, by
digest, and the repeated ones are joined to shards of the pages that need
them. The result is that of the suffix arrays over the host.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator
from hashlib import blake2b

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import stored, texts_of
from .html_blocks import ARTICLE, NEUTRAL, boxed_blocks

#: Rows of runs that a task hands over at a time.
RUNS_AT_A_TIME = 1 << 16
MIN_TOKENS = 6
MIN_PAGES = 3
PAGES_PER_SHARD = 512
#: Tables of up to this many large hosts are broadcast, longer ones joined by
#: a shuffle.
MAX_BROADCAST_HOSTS = 10_000


def suffix_ranks(tokens: np.ndarray, depth: int) -> tuple[np.ndarray, np.ndarray]:
    """The suffix array of ``tokens`` sorted by at least ``depth`` leading
    tokens, and each suffix's rank (equal where those tokens are), by prefix
    doubling."""
    rank = np.unique(tokens, return_inverse=True)[1].astype(np.int64)
    order, width = np.argsort(rank, kind="stable"), 1
    while width < depth:
        tail = np.full(len(rank), -1, np.int64)
        step = min(width, depth - width)
        tail[:-step] = rank[step:] if step < len(rank) else tail[:-step]
        key = rank * (len(rank) + 1) + tail + 1
        order = np.argsort(key, kind="stable")
        rank = np.empty_like(rank)
        rank[order] = np.cumsum(np.r_[False, key[order][1:] != key[order][:-1]])
        width += step
    return order, rank


def covered(
    streams: list[list[str]], min_tokens: int = MIN_TOKENS, min_pages: int = MIN_PAGES, owners: list[int] | None = None
) -> list[np.ndarray]:
    """For each stream's tokens, which lie in a substring of ``min_tokens`` or
    more that occurs on ``min_pages`` (two at least) or more distinct pages:
    each stream is one, or belongs to the page that ``owners`` numbers."""
    sizes = [len(s) for s in streams]
    if sum(sizes) < min_tokens:
        return [np.zeros(n, bool) for n in sizes]
    number: dict[str, int] = {}
    joined, page_of = [], []
    for page, stream in enumerate(streams):  # each ends with a token of its own
        joined += [number.setdefault(t, len(number)) for t in stream]
        joined.append(-1 - page)
        page_of += [owners[page] if owners else page] * (len(stream) + 1)
    tokens, pages = np.array(joined, np.int64), np.array(page_of, np.int64)
    order, rank = suffix_ranks(tokens, min_tokens)
    grouped = rank[order] * len(streams) + pages[order]  # suffixes of a rank lie together
    first = np.unique(grouped)
    n_pages = np.bincount(first // len(streams), minlength=int(rank.max()) + 1)
    starts = np.flatnonzero(n_pages[rank] >= min_pages)
    marks = np.zeros(len(tokens) + min_tokens + 1, np.int64)
    np.add.at(marks, starts, 1)
    np.add.at(marks, starts + min_tokens, -1)
    inside = np.cumsum(marks)[: len(tokens)] > 0
    begins = np.cumsum([0, *(n + 1 for n in sizes)])
    return [inside[b : b + n] for b, n in zip(begins, sizes)]


Page = list[tuple[int, str, str]]  # zone, text and box of each block


def _main_text(page: Page, boiler: np.ndarray, dropped: set[str]) -> str:
    """The article without ``dropped`` boxes, or else the unique runs of the
    neutral blocks; ``boiler`` marks the tokens beside the article that
    repeat."""
    kept = [text for zone, text, box in page if zone == ARTICLE and not (box and box in dropped)]
    if not any(zone == ARTICLE for zone, *_ in page):
        at = 0
        for zone, text, _ in page:
            tokens = text.split()
            unique = [t for t, b in zip(tokens, boiler[at : at + len(tokens)]) if not b]
            at += len(tokens)
            if zone == NEUTRAL and unique:
                kept.append(" ".join(unique))
    return "\n\n".join(kept)


def _around(page: Page) -> list[str]:
    return [t for zone, text, _ in page if zone != ARTICLE for t in text.split()]


def _boxes(page: Page) -> dict[str, list[str]]:
    """The tokens of each box of the article."""
    out: dict[str, list[str]] = {}
    for zone, text, box in page:
        if zone == ARTICLE and box.startswith("box "):
            out.setdefault(box, []).extend(text.split())
    return out


def _followers(page: Page) -> set[str]:
    """The kinds of elements with articles after the page's own."""
    return {box for zone, _, box in page if zone == ARTICLE and box.startswith("after ")}


def _signature(page: Page) -> int:
    """A number for the text of the page's own article."""
    own = "\n".join(text for zone, text, box in page if zone == ARTICLE and not box.startswith("after "))
    return int.from_bytes(blake2b(own.encode("utf-8", "surrogatepass"), digest_size=8).digest(), "little", signed=True)


def _dropped(page: Page, repeats: dict[str, np.ndarray], followers: set[str]) -> set[str]:
    """The boxes that go: those covered as a whole by what ``repeats``, and
    the ``followers`` that repeat."""
    own = sum(len(text.split()) for zone, text, box in page if zone == ARTICLE and not box.startswith("after "))
    whole = {box for box, flags in repeats.items() if len(flags) and flags.all()}
    copied = 2 * sum(int(flags.sum()) for flags in repeats.values()) >= own
    return (set() if copied else whole) | (_followers(page) & followers)


def main_texts(pages: list[list[tuple]], min_tokens: int = MIN_TOKENS, min_pages: int = MIN_PAGES) -> list[str]:
    """The main text of each page of a host."""
    pages = [[(*block, "")[:3] for block in page] for page in pages]
    repeated = covered([_around(page) for page in pages], min_tokens, min_pages)
    number: dict[int, int] = {}
    own = [number.setdefault(_signature(page), len(number)) for page in pages]
    boxes = [(k, box, tokens) for k, page in enumerate(pages) for box, tokens in _boxes(page).items()]
    flags: list[dict[str, np.ndarray]] = [{} for _ in pages]
    if boxes:
        owners = [own[k] for k, _, _ in boxes]
        owners = np.unique(owners, return_inverse=True)[1].tolist()
        for (k, box, _), marked in zip(boxes, covered([t for _, _, t in boxes], min_tokens, min_pages, owners)):
            flags[k][box] = marked
    after = Counter(kind for kind, _ in {(kind, own[k]) for k, page in enumerate(pages) for kind in _followers(page)})
    comments = {kind for kind, n in after.items() if n >= min_pages}
    return [_main_text(page, boiler, _dropped(page, of, comments)) for page, boiler, of in zip(pages, repeated, flags)]


def runs_of(tokens: list[str], min_tokens: int) -> list[bytes]:
    """The digest of each run of ``min_tokens`` tokens."""
    return [
        blake2b(" ".join(tokens[i : i + min_tokens]).encode("utf-8", "surrogatepass"), digest_size=16).digest()
        for i in range(len(tokens) - min_tokens + 1)
    ]


def _parse(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        names = batch.schema.names
        for start, texts in texts_of(batch, "html"):
            parsed = [boxed_blocks(t) for t in texts]
            columns = [batch.column(names.index(c)).slice(start, len(texts)) for c in names if c != "html"]
            columns.append(pa.array([bytes(z for z, _, _ in p) for p in parsed], pa.binary()))
            columns.append(pa.array([[t for _, t, _ in p] for p in parsed], pa.list_(pa.string())))
            columns.append(pa.array([[b for _, _, b in p] for p in parsed], pa.list_(pa.string())))
            yield pa.record_batch(columns, names=[c for c in names if c != "html"] + ["zones", "texts", "boxes"])


def _page(row: dict) -> Page:
    return list(zip(row["zones"], row["texts"], row["boxes"]))


_RESULT = "page_id long, url string, text string, n_chars long"


def _results(held: list[dict], texts: list[str]) -> pa.RecordBatch:
    return pa.record_batch(
        [
            pa.array([r["page_id"] for r in held], pa.int64()),
            pa.array([r["url"] for r in held], pa.string()),
            pa.array(texts, pa.string()),
            pa.array([len(t) for t in texts], pa.int64()),
        ],
        names=["page_id", "url", "text", "n_chars"],
    )


def extract_main_text(pages: DataFrame, min_tokens: int = MIN_TOKENS, min_pages: int = MIN_PAGES, pages_per_shard: int = PAGES_PER_SHARD) -> DataFrame:
    """One row per page: ``page_id, url, text, n_chars``.

    A null html is empty and gives the empty text. Pages with a null url, or
    one without a host, count as one host. Repeated rows count as distinct
    pages and give repeated results; null ids pass through; other columns
    are ignored; an empty table gives an empty result.
    """
    host = F.coalesce(F.lower(F.regexp_extract("url", r"^[a-zA-Z][a-zA-Z0-9+.-]*://([^/?#]*)", 1)), F.lit(""))
    rows = pages.select(F.col("page_id").cast("long").alias("page_id"), "url", "html", host.alias("host"))
    sizes = rows.groupBy("host").agg(F.count(F.lit(1)).alias("n")).filter(F.col("n") > pages_per_shard)
    large = stored(sizes.select(F.col("host").alias("large_host"), F.ceil(F.col("n") / pages_per_shard).alias("shards")), "html-hosts")
    n_large = large.count()
    if not n_large:
        return _whole_hosts(rows, min_tokens, min_pages)
    if n_large <= MAX_BROADCAST_HOSTS:
        large = F.broadcast(large)
    on = rows["host"] == large["large_host"]
    small = _whole_hosts(rows.join(large, on, "left_anti"), min_tokens, min_pages)
    return small.unionByName(_large_hosts(rows.join(large, on), min_tokens, min_pages))


def _whole_hosts(rows: DataFrame, min_tokens: int, min_pages: int) -> DataFrame:
    """Main texts of the pages of hosts that a task can hold."""
    parsed = rows.mapInArrow(_parse, "page_id long, url string, host string, zones binary, texts array<string>, boxes array<string>")

    def finish(held: list[dict]) -> pa.RecordBatch:
        return _results(held, main_texts([_page(r) for r in held], min_tokens, min_pages))

    def by_host(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[dict] = []
        for batch in batches:
            for start in range(0, batch.num_rows, 128):
                for row in batch.slice(start, 128).to_pylist():
                    if held and row["host"] != held[0]["host"]:
                        yield finish(held)
                        held = []
                    held.append(row)
        if held:
            yield finish(held)

    return parsed.repartition("host").sortWithinPartitions("host", "page_id").mapInArrow(by_host, _RESULT)


def _large_hosts(rows: DataFrame, min_tokens: int, min_pages: int) -> DataFrame:
    """The same for larger hosts. Pages with an article without boxes need
    nothing of the others and stay where they are read; the others are written
    once, with the shard they belong to, however often a row repeats."""

    def parsed(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[pa.RecordBatch, list[Page]]]:
        for batch in _parse(batches):
            held = batch.select(["zones", "texts", "boxes"]).to_pylist()
            yield batch, [_page(r) for r in held]

    def alone(page: Page) -> bool:
        return any(zone == ARTICLE for zone, *_ in page) and not any(box for *_, box in page)

    def box_runs(page: Page) -> set[bytes]:
        """Digests of the runs in boxes, and of the kinds of followers; they
        differ from those of the tokens around the article."""
        found = {b"b" + run for tokens in _boxes(page).values() for run in runs_of(tokens, min_tokens)}
        return found | {b"f" + kind.encode("utf-8", "surrogatepass") for kind in _followers(page)}

    def with_article(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, found in parsed(batches):
            keep = [k for k, page in enumerate(found) if alone(page)]
            ids = batch.select(["page_id", "url"]).take(pa.array(keep, pa.int64())).to_pylist()
            yield _results(ids, [_main_text(found[k], np.empty(0), set()) for k in keep])

    def without_article(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, found in parsed(batches):
            yield batch.filter(pa.array([not alone(page) for page in found], pa.bool_()))

    def counted(counts: Counter) -> Iterator[pa.RecordBatch]:
        keys = list(counts)
        for start in range(0, len(keys), RUNS_AT_A_TIME):
            part = keys[start : start + RUNS_AT_A_TIME]
            hosts, shards, runs = zip(*part)
            yield pa.record_batch(
                [pa.array(hosts, pa.string()), pa.array(shards, pa.int32()), pa.array(runs, pa.binary()), pa.array([counts[k] for k in part], pa.int64())],
                names=["host", "shard", "run", "n"],
            )

    def page_runs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, found in parsed(batches):
            counts: Counter = Counter()
            for name, page in zip(batch.column(batch.schema.get_field_index("host")).to_pylist(), found):
                counts.update((name, 0, run) for run in set(runs_of(_around(page), min_tokens)))
            yield from counted(counts)

    def shard_runs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for start in range(0, batch.num_rows, 128):
                counts: Counter = Counter()
                for r in batch.slice(start, 128).to_pylist():
                    page = _page(r)
                    if not any(zone == ARTICLE for zone, *_ in page):
                        counts.update((r["host"], r["shard"], run) for run in runs_of(_around(page), min_tokens))
                    counts.update((r["host"], r["shard"], run) for run in box_runs(page))
                yield from counted(counts)

    def boxes_of_articles(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for start in range(0, batch.num_rows, 128):
                found: set[tuple[str, bytes, int]] = set()
                for r in batch.slice(start, 128).to_pylist():
                    page = _page(r)
                    found.update((r["host"], run, _signature(page)) for run in box_runs(page))
                part = list(found)
                hosts, own, signatures = zip(*part) if part else ((), (), ())
                yield pa.record_batch(
                    [pa.array(hosts, pa.string()), pa.array(own, pa.binary()), pa.array(signatures, pa.int64())], names=["host", "run", "article"]
                )

    def marked(tokens: list[str], kind: bytes, repeated: set[bytes]) -> np.ndarray:
        flags = np.zeros(len(tokens), bool)
        for i, run in enumerate(runs_of(tokens, min_tokens)):
            if kind + run in repeated:
                flags[i : i + min_tokens] = True
        return flags

    def by_shard(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shard, repeated = None, set()
        for batch in batches:
            for start in range(0, batch.num_rows, 128):
                held, texts = [], []
                for r in batch.slice(start, 128).to_pylist():
                    if (r["host"], r["shard"]) != shard:
                        shard, repeated = (r["host"], r["shard"]), set()
                    if r["run"] is not None:  # the runs of a shard come before its pages
                        repeated.add(r["run"])
                        continue
                    page = _page(r)
                    boiler = marked(_around(page), b"", repeated)
                    boxes = {box: marked(tokens, b"b", repeated) for box, tokens in _boxes(page).items()}
                    comments = {kind for kind in _followers(page) if b"f" + kind.encode("utf-8", "surrogatepass") in repeated}
                    held.append(r)
                    texts.append(_main_text(page, boiler, _dropped(page, boxes, comments)))
                yield _results(held, texts)

    articles = rows.mapInArrow(with_article, _RESULT)
    shard = F.pmod(F.xxhash64(F.monotonically_increasing_id()), "shards").cast("int")
    dealt = rows.select("page_id", "url", "html", "host", shard.alias("shard"))
    columns = "page_id long, url string, host string, shard int, zones binary, texts array<string>, boxes array<string>"
    bare = stored(dealt.mapInArrow(without_article, columns), "html-bare")
    if bare.isEmpty():
        return articles
    runs = "host string, shard int, run binary, n long"
    counts = rows.select("page_id", "url", "html", "host").mapInArrow(page_runs, runs).groupBy("host", "run").agg(F.sum("n").alias("n"))
    repeated = counts.filter(F.col("n") >= min_pages).select("host", "run")
    in_boxes = bare.mapInArrow(boxes_of_articles, "host string, run binary, article long").distinct()
    in_boxes = in_boxes.groupBy("host", "run").agg(F.count(F.lit(1)).alias("n")).filter(F.col("n") >= min_pages)
    repeated = repeated.unionByName(in_boxes.select("host", "run"))
    wanted = bare.mapInArrow(shard_runs, runs).select("host", "shard", "run").distinct()
    told = wanted.join(repeated, ["host", "run"]).select("host", "shard", "run")
    both = bare.unionByName(told, allowMissingColumns=True).repartition("host", "shard")
    spread = both.sortWithinPartitions("host", "shard", F.col("run").isNull(), "page_id")
    return articles.unionByName(spread.mapInArrow(by_shard, _RESULT))
