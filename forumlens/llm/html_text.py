"""Main text of web pages by the wrappers of their hosts.

Pages of a host with the same folded stream have one shape. Shapes are counted and
combined where the pages are read, so a host of many pages sends a few rows; its
wrapper is inferred from them in two steps, first over parts of the shapes, then
over the parts' wrappers. Extraction aligns each page with its host's wrapper, which
tells the template's text; what is main text otherwise is judged by the page itself.
"""

from __future__ import annotations

from collections import OrderedDict
from collections.abc import Iterator

import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from forumlens.llm import wrappers as wr
from forumlens.session import keep

#: Parts of a host's shapes whose wrappers are inferred apart.
PARTS = 8
#: Shapes gathered in a task before they are sent on, and alignments remembered.
GATHERED = 5000
REMEMBERED = 2000


def host(url: Column) -> Column:
    """The host of a url in lower case; empty if it has none."""
    return F.lower(F.regexp_extract(F.coalesce(url, F.lit("")), r"^[a-zA-Z][a-zA-Z0-9+.-]*://(?:[^/?#@]*@)?([^/?#:]*)", 1))


def _shapes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    gathered: dict[tuple[str, str], list] = {}

    def rows() -> pa.RecordBatch:
        keys = list(gathered)
        for nodes, pages in gathered.values():
            for slot in wr.slots(nodes):
                slot.seen = pages
        return pa.RecordBatch.from_pydict(
            {
                "host": [k[0] for k in keys],
                "shape": [k[1] for k in keys],
                "wrapper": [wr.dump(gathered[k][0]) for k in keys],
                "pages": [gathered[k][1] for k in keys],
            }
        )

    for batch in batches:
        for name, html in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
            nodes = wr.page_nodes(wr.read_page(html.as_py()))
            key = (name, ",".join(n.key for n in nodes))
            have = gathered.get(key)
            if have is None:
                gathered[key] = [nodes, 1]
            else:
                for a, b in zip(wr.slots(have[0]), wr.slots(nodes), strict=True):
                    if a.same != b.same:
                        a.same = None
                have[1] += 1
            if len(gathered) >= GATHERED:
                yield rows()
                gathered.clear()
    if gathered:
        yield rows()


def _merged(group: pd.DataFrame) -> tuple[str, int]:
    """One wrapper of many, the most frequent first; the order of rows does not matter."""
    counts = group.groupby("shape")["pages"].sum() if "shape" in group else None
    rows = group.assign(weight=group["shape"].map(counts) if counts is not None else group["pages"])
    rows = rows.sort_values(["weight", "wrapper"], ascending=[False, True])
    merged = None
    for text in rows["wrapper"]:
        merged = wr.load(text) if merged is None else wr.merge(merged, wr.load(text))
    return wr.dump(merged or []), int(rows["pages"].sum())


def infer(pages: DataFrame) -> DataFrame:
    """``host, wrapper, pages``: the wrapper of each host of ``pages`` (``url, html``)."""
    shapes = pages.select(host(F.col("url")).alias("host"), "html").mapInArrow(_shapes, "host string, shape string, wrapper string, pages long")

    def part(key: tuple, group: pd.DataFrame) -> pd.DataFrame:
        wrapper, n = _merged(group)
        return pd.DataFrame({"host": [key[0]], "wrapper": [wrapper], "pages": [n]})

    schema = "host string, wrapper string, pages long"
    parted = shapes.groupBy("host", F.pmod(F.xxhash64("shape"), F.lit(PARTS)).alias("part")).applyInPandas(part, schema)
    return parted.groupBy("host").applyInPandas(part, schema)


def _texts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    loaded: OrderedDict[str, list[bool]] = OrderedDict()
    known: OrderedDict[tuple[str, str], list[bool]] = OrderedDict()

    def flags(page: wr.Page, nodes: list[wr.Node], wrapper: str | None) -> list[bool]:
        """Per text of the page whether it is content."""
        level = [0] * len(page.texts)
        for slot, where in wr.levels(nodes, [len(t) for t in page.texts]):
            for p in slot.places:
                level[p] = where
        best = max(level)
        if wrapper:
            if wrapper not in loaded:
                loaded[wrapper] = wr.template_slots(wr.load(wrapper))
                if len(loaded) > REMEMBERED:
                    loaded.popitem(last=False)
            pairs = wr.flags_of(nodes, wr.load(wrapper), loaded[wrapper], [False] * len(wr.slots(nodes)))
        else:
            pairs = [(slot, False) for slot in wr.slots(nodes)]
        main = [best > 0 and where == best for where in level]
        template = {p for slot, constant in pairs if constant for p in slot.places}
        # A page of constant text alone keeps it
        own = [take and p not in template for p, take in enumerate(main)]
        taken = own if any(own) else main
        # Outside any content element, text that is mostly links is a menu
        body = best == 1
        result = [False] * len(page.texts)
        for slot, _ in pairs:
            links = sum(page.linked[p] for p in slot.places) > 0.5 * sum(len(page.texts[p]) for p in slot.places)
            for p in slot.places:
                result[p] = taken[p] and not (body and links)
        return result

    for batch in batches:
        names = batch.schema.names
        html, wrapper = (batch.column(names.index(c)) for c in ("html", "_wrapper"))
        texts = []
        for i in range(batch.num_rows):
            page = wr.read_page(html[i].as_py())
            if not page.texts:
                texts.append("")
                continue
            text = wrapper[i].as_py()
            # Equal streams of a host have equal flags, unless links or lengths decide
            key = (text or "", " ".join(page.symbols)) if not any(page.linked) and not any(s == "form" or s.startswith("form ") for s in page.symbols) else None
            take = known.get(key) if key else None
            if take is None:
                take = flags(page, wr.page_nodes(page), text)
                if key:
                    known[key] = take
                    if len(known) > REMEMBERED:
                        known.popitem(last=False)
            texts.append("\n".join(t for t, f in zip(page.texts, take, strict=True) if f))
        kept = [c for c in names if c not in ("html", "_wrapper")]
        yield pa.RecordBatch.from_arrays([*[batch.column(names.index(c)) for c in kept], pa.array(texts, pa.string())], [*kept, "text"])


def extract(pages: DataFrame) -> DataFrame:
    """``page_id, url, text``: the main text of each row of ``pages``.

    Blocks are joined by line breaks in page order. A null or empty html, or one
    without main text, gives an empty text; a page whose url has no host shares
    the wrapper of all such pages. Pages that repeat are rows of their own.
    """
    inferred = keep(infer(pages), "wrappers").select(F.col("host").alias("_host2"), F.col("wrapper").alias("_wrapper"))
    rows = pages.select("page_id", "url", "html").withColumn("_host", host(F.col("url")))
    joined = rows.join(inferred, F.col("_host") == F.col("_host2"), "left").select("page_id", "url", "html", "_wrapper")
    kind = pages.schema["page_id"].dataType.simpleString()
    return joined.mapInArrow(_texts, f"page_id {kind}, url string, text string")
