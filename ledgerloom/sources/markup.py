"""Sources of XML and HTML."""

from __future__ import annotations

import re
import xml.etree.ElementTree as ET
from collections.abc import Iterator
from html.parser import HTMLParser

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, MapType, StringType, StructField, StructType


def xml_documents(whole: DataFrame, root: str = "us-patent-grant") -> DataFrame:
    """(file, pos, xml) of files that hold several XML documents one after the other."""
    found = F.regexp_extract_all("text", F.lit(rf"(?is)<{root}[\s>].*?</{root}>"), F.lit(0))
    return whole.select("file", F.posexplode(found).alias("pos", "xml"))


def _text(node: ET.Element | None) -> str:
    return "" if node is None else "".join(node.itertext()).strip()


def _at(node: ET.Element, path: str) -> str:
    return _text(node.find(path))


_PERSON = ["last", "first", "orgname", "role", "street", "city", "state", "country", "postcode", "nationality", "residence"]
_CITED = ["country", "number", "kind", "name", "date", "category", "text"]
_RELATED = ["type", "side", "country", "number", "kind", "date", "status"]


def _rows(fields: list[str]) -> ArrayType:
    return ArrayType(StructType([StructField(f, StringType()) for f in fields]))


GRANT = StructType(
    [StructField(n, StringType()) for n in ("error", "patent", "kind", "date", "appnum", "appdate", "apptype", "claims", "title", "abstract")]
    + [StructField(n, _rows(_PERSON)) for n in ("inventors", "assignees", "lawyers")]
    + [StructField("citations", _rows(_CITED)), StructField("related", _rows(_RELATED)), StructField("classes", _rows(["prim", "class", "subclass"]))]
)


def _person(node: ET.Element, inner: str | None = None) -> dict:
    book = node.find("addressbook") if node.find("addressbook") is not None else node
    address = book.find("address") if book.find("address") is not None else book
    got = {"last": _at(book, "last-name"), "first": _at(book, "first-name"), "orgname": _at(book, "orgname"), "role": _at(book, "role")}
    got |= {k: _at(address, k) for k in ("street", "city", "state", "country", "postcode")}
    return got | {"nationality": _at(node, "nationality/country"), "residence": _at(node, "residence/country")}


#: Kinds of related documents: type -> path of the relation.
RELATIONS = ["continuation-in-part", "continuation", "division", "reissue"]


def read_grant(xml: str) -> dict:
    """A grant document as a record of texts and lists; error says what is wrong with one that can't be read."""
    try:
        root = ET.fromstring(re.sub(r"&(?!amp;|lt;|gt;|quot;|apos;|#)\w+;", "", xml))
        bib = root.find("us-bibliographic-data-grant")
        if bib is None:
            raise ValueError("no bibliographic data")
        pub, app = bib.find("publication-reference/document-id"), bib.find("application-reference/document-id")
        if pub is None or not _at(pub, "doc-number"):
            raise ValueError("no document number")
        out = {"error": None, "patent": _at(pub, "doc-number"), "kind": _at(pub, "kind"), "date": _at(pub, "date")}
        out |= {"appnum": _at(app, "doc-number"), "appdate": _at(app, "date")} if app is not None else {"appnum": "", "appdate": ""}
        ref = bib.find("application-reference")
        out |= {"apptype": ref.get("appl-type", "") if ref is not None else "", "claims": _at(bib, "number-of-claims"), "title": _at(bib, "invention-title"), "abstract": _text(root.find("abstract"))}
        out["inventors"] = [_person(n) for p in ("parties/applicants/applicant", "us-parties/inventors/inventor") for n in bib.findall(p)]
        out["assignees"] = [_person(n) for n in bib.findall("assignees/assignee")]
        out["lawyers"] = [_person(n) for n in bib.findall("parties/agents/agent")]
        cited = []
        for c in [*bib.findall("references-cited/citation"), *bib.findall("us-references-cited/us-citation")]:
            doc = c.find("patcit/document-id")
            row = {"category": _at(c, "category"), "text": _at(c, "othercit")}
            cited.append(row | ({"country": _at(doc, "country"), "number": _at(doc, "doc-number"), "kind": _at(doc, "kind"), "name": _at(doc, "name"), "date": _at(doc, "date")} if doc is not None else dict.fromkeys(("country", "number", "kind", "name", "date"), "")))
        out["citations"] = cited
        related = []
        for kind in RELATIONS:
            for rel in bib.findall(f"us-related-documents/{kind}/relation"):
                for side, path in (("-1", "child-doc"), ("1", "parent-doc")):
                    for doc in rel.findall(path):
                        d = doc.find("document-id")
                        if d is not None:
                            related.append({"type": kind, "side": side, "country": _at(d, "country"), "number": _at(d, "doc-number"), "kind": _at(d, "kind"), "date": _at(d, "date"), "status": _at(doc, "parent-status")})
        for kind in ("related-publication", "us-provisional-application"):
            for d in bib.findall(f"us-related-documents/{kind}/document-id"):
                related.append({"type": kind, "side": "0", "country": _at(d, "country"), "number": _at(d, "doc-number"), "kind": _at(d, "kind"), "date": _at(d, "date"), "status": ""})
        out["related"] = related
        classes = []
        for prim, path in (("1", "classification-national/main-classification"), ("0", "classification-national/further-classification")):
            for n in bib.findall(path):
                t = _text(n)
                classes.append({"prim": prim, "class": t[:3].strip(), "subclass": t[3:].strip()})
        out["classes"] = classes
        return out
    except (ET.ParseError, ValueError) as e:
        return {f.name: None for f in GRANT.fields} | {"error": str(e)}


def grants(documents: DataFrame) -> DataFrame:
    """documents (file, pos, xml) with the fields of GRANT; a broken document has only error set, the others go on."""

    def read(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            recs = [read_grant(x) for x in b["xml"]]
            yield pd.concat([b[["file", "pos"]].reset_index(drop=True), pd.DataFrame(recs, columns=[f.name for f in GRANT.fields], dtype=object)], axis=1)

    schema = StructType([documents.schema["file"], documents.schema["pos"], *GRANT.fields])
    return documents.select("file", "pos", "xml").mapInPandas(read, schema)


def tag_paths(documents: DataFrame, deepest: int = 10) -> DataFrame:
    """(path, n): distinct tag paths, down to a depth, of elements that hold letters or digits, with their number."""

    def walk(xml: str | None) -> list[str]:
        try:
            root = ET.fromstring(xml or "")
        except ET.ParseError:
            return []
        nodes = []  # path, depth, whether it holds letters or digits, number of the node above; parents come first
        stack = [(root, "", 1, -1)]
        while stack:
            node, path, depth, above = stack.pop()
            here, at = f"{path}/{node.tag}" if depth <= deepest else path, len(nodes)
            nodes.append([here, depth, bool(re.search(r"\w", " ".join([node.text or "", *(c.tail or "" for c in node)]))), above])
            stack += [(child, here, depth + 1, at) for child in node]
        for _, _, filled, above in reversed(nodes):
            if filled and above >= 0:
                nodes[above][2] = True
        return [path for path, depth, filled, _ in nodes if filled and depth <= deepest]

    paths = F.udf(walk, ArrayType(StringType()), useArrow=True)
    return documents.select(F.explode(paths("xml")).alias("path")).groupBy("path").agg(F.count(F.lit(1)).alias("n"))


class _Table(HTMLParser):
    """Rows of table cells with their links, and what follows bold labels."""

    def __init__(self) -> None:
        super().__init__(convert_charrefs=True)
        self.rows: list[dict] = []
        self.pairs: dict[str, str] = {}
        self.links: list[tuple[str, str]] = []
        self.cells: list[str] | None = None
        self.row: dict = {}
        self.in_cell = self.in_bold = False
        self.bold = self.key = self.text = ""
        self.href: str | None = None

    def handle_starttag(self, tag: str, attrs: list) -> None:
        at = dict(attrs)
        if tag == "tr":
            self.cells, self.row = [], {"color": at.get("bgcolor") or "", "link": ""}
        elif tag in ("td", "th") and self.cells is not None:
            self.cells.append("")
            self.in_cell = True
        elif tag == "a" and at.get("href"):
            self.href, self.text = at["href"], ""
            if self.cells is not None and not self.row["link"]:
                self.row["link"] = at["href"]
        elif tag == "option" and at.get("value"):
            self.href, self.text = at["value"], ""
        elif tag == "b":
            self.in_bold, self.bold = True, ""

    def handle_endtag(self, tag: str) -> None:
        if tag == "tr" and self.cells is not None:
            self.rows.append(self.row | {"cells": [" ".join(c.split()) for c in self.cells]})
            self.cells = None
        elif tag in ("td", "th"):
            self.in_cell = False
        elif tag in ("a", "option") and self.href is not None:
            self.links.append((self.href, " ".join(self.text.split())))
            self.href = None
        elif tag == "b":
            self.in_bold, self.key = False, self.bold.strip().rstrip(":").strip() if self.bold.strip().endswith(":") else ""

    def handle_data(self, data: str) -> None:
        if self.in_cell and self.cells:
            self.cells[-1] += data
        if self.href is not None:
            self.text += data
        if self.in_bold:
            self.bold += data
        elif self.key and data.strip():
            self.pairs.setdefault(self.key, data.strip())
            self.key = ""


def _parsed(html: str | None) -> _Table:
    p = _Table()
    p.feed(html or "")
    p.close()
    return p


def html_rows(pages: DataFrame, html: str, color: str | None = None) -> DataFrame:
    """pages with pos, cells and link of each table row (of a background colour, if one is given)."""
    kind = ArrayType(StructType([StructField("color", StringType()), StructField("link", StringType()), StructField("cells", ArrayType(StringType()))]))
    rows = F.udf(lambda x: [(r["color"], r["link"], r["cells"]) for r in _parsed(x).rows], kind)
    df = pages.select(*(c for c in pages.columns if c != html), F.posexplode(rows(html)).alias("pos", "__row"))
    df = df.where(F.upper("__row.color") == color.upper()) if color else df
    return df.select(*(c for c in df.columns if c != "__row"), F.col("__row.cells").alias("cells"), F.col("__row.link").alias("link"))


def html_pairs(html: Column) -> Column:
    """Map of the bold labels that end in a colon to the text after them."""
    return F.udf(lambda x: _parsed(x).pairs, MapType(StringType(), StringType()))(html)


def html_links(html: Column) -> Column:
    """Links and options as an array of (url, text)."""
    kind = ArrayType(StructType([StructField("url", StringType()), StructField("text", StringType())]))
    return F.udf(lambda x: _parsed(x).links, kind)(html)
