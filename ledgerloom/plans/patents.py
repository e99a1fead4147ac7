"""Patents: grant documents into nine tables, and nested documents out of them."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerloom.functions.text import patent_number, patent_type
from ledgerloom.operators.reshape import attach_children, struct_of
from ledgerloom.operators.tables import drop_columns


def _children(good: DataFrame, items: str, seq: str, fields: dict[str, Column]) -> DataFrame:
    rows = good.select("patent", F.posexplode(items).alias(seq, "x"))
    return rows.select("patent", *(c.alias(n) for n, c in fields.items()), seq)


def patent_tables(grants: DataFrame) -> dict[str, DataFrame]:
    """The nine tables of parsed grants; children are numbered from 0 in document order, citations of patents and of
    other works each on their own. Related documents have a real ordinal and their role as a column.
    """
    x = lambda f: F.col("x").getField(f)
    number = lambda f: F.col(f).try_cast("int")
    good = grants.where("error IS NULL")
    place = {n: x(f) for n, f in (("street", "street"), ("city", "city"), ("state", "state"), ("country", "country"), ("zipcode", "postcode"))}
    person = {"firstname": x("first"), "lastname": x("last")}
    patent = good.select("patent", "kind", number("claims").alias("claims"), number("apptype").alias("apptype"), "appnum", number("date").alias("gdate"), F.left("date", F.lit(4)).try_cast("int").alias("gyear"), number("appdate").alias("appdate"), F.left("appdate", F.lit(4)).try_cast("int").alias("appyear"), patent_type(F.col("patent")).alias("pattype"))
    named = F.when(x("orgname") != "", x("orgname")).otherwise(F.concat_ws(", ", F.nullif(x("last"), F.lit("")), F.nullif(x("first"), F.lit(""))))
    asg = {"asgtype": F.when(x("orgname") != "", x("role").try_cast("int")).otherwise(1), "assignee": named} | {k: v for k, v in place.items() if k not in ("street", "zipcode")}
    cited = good.select("patent", F.filter("citations", lambda c: c["country"] != "").alias("p"), F.filter("citations", lambda c: c["country"] == "").alias("o"))
    citation = {"cit_date": x("date").try_cast("int"), "cit_name": x("name"), "cit_kind": x("kind"), "cit_country": x("country"), "citation": patent_number(x("number"), x("country")), "category": x("category")}
    related = {"doctype": x("type"), "side": x("side").try_cast("int"), "country": x("country"), "relpatent": x("number"), "kind": x("kind"), "reldate": x("date").try_cast("int"), "status": x("status")}
    return {
        "patent": patent,
        "patdesc": good.select("patent", "abstract", "title"),
        "inventor": _children(good, "inventors", "invseq", person | place | {"nationality": x("nationality")}),
        "assignee": _children(good, "assignees", "asgseq", asg | {"nationality": x("nationality"), "residence": x("residence")}),
        "class": _children(good, "classes", "seq", {"prim": x("prim").try_cast("int"), "class": x("class"), "subclass": x("subclass")}).drop("seq"),
        "citation": _children(cited, "p", "citseq", citation),
        "sciref": _children(cited, "o", "citseq", {"descrip": x("text")}),
        "lawyer": _children(good, "lawyers", "lawseq", person | {"lawcountry": x("country"), "orgname": x("orgname")}),
        "usreldoc": _children(good, "related", "orderseq", related),
    }


def patent_documents(tables: dict[str, DataFrame]) -> DataFrame:
    """One nested document for each patent: people with their places, classes, citations; empty children are empty arrays."""
    place = {"a": "street", "i": "city", "S": "state", "C": "country", "p": "zipcode"}
    inventor = drop_columns(struct_of(tables["inventor"], "place", place), place.values())
    assignee = drop_columns(struct_of(tables["assignee"], "place", {k: v for k, v in place.items() if v in tables["assignee"].columns}), place.values())
    inventor = inventor.withColumn("nationality", F.when(F.lower("nationality") != "omitted", F.col("nationality")))
    children = {"inventors": (inventor, "invseq"), "assignees": (assignee, "asgseq"), "classes": (tables["class"], "class"), "citations": (tables["citation"].select("patent", "citseq", "citation"), "citseq"), "references": (tables["sciref"], "citseq")}
    return attach_children(tables["patent"].join(tables["patdesc"], "patent", "left"), "patent", children)
