"""Licence scans by canonical digest: whole texts joined to known licence digests.

A text is made canonical with column expressions: lower case, spellings that the public
matching guidelines count as equal are made one, copyright and "all rights reserved" lines
go, everything but letters and digits is a blank, runs of blanks are one. The SHA-256 of
the result is looked up in the digests of known licences. Whole documents are looked up, and
each of their lines, so that the usual notice of a licence is found inside a text too.

The known texts are a small table in ``licence_texts.py`` and the files beside it; its
canonical forms are made by the same expressions, and it is joined by broadcast (its size is
fixed by those files). A table of further texts or digests can be given; it is joined
without a broadcast of our own, whole texts and lines alike, and may be of any size.

Defined cases: null, empty, and texts without letters or digits match nothing; repeated
rows get a row each; texts that differ only in case, punctuation, copyright lines or such
spellings are the same licence; further columns stay as they are.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from riskloom.llm.licence_texts import NOTICES, TEXTS, long_texts

# Spellings that the licence matching guidelines treat as equal.
SPELLINGS = {
    "acknowledgement": "acknowledgment",
    "analogue": "analog",
    "analyse": "analyze",
    "artefact": "artifact",
    "authorisation": "authorization",
    "authorised": "authorized",
    "behaviour": "behavior",
    "cancelled": "canceled",
    "catalogue": "catalog",
    "centre": "center",
    "copyright holder": "copyright owner",
    "emphasised": "emphasized",
    "favour": "favor",
    "fulfil": "fulfill",
    "initialise": "initialize",
    "judgement": "judgment",
    "labelled": "labeled",
    "licence": "license",
    "maximise": "maximize",
    "modelled": "modeled",
    "non-commercial": "noncommercial",
    "optimise": "optimize",
    "organisation": "organization",
    "organise": "organize",
    "per cent": "percent",
    "practise": "practice",
    "programme": "program",
    "realise": "realize",
    "recognise": "recognize",
    "signalling": "signaling",
    "sub-license": "sublicense",
    "utilisation": "utilization",
    "whilst": "while",
    "wilful": "willful",
    "https": "http",
}
_COPYRIGHT_LINES = (
    r"(?m)^[^\p{L}\p{N}\n©]*(?:©|\(c\)|copyright\s*(?:\(c\)|©|\d|:|<|\[|\{|by\b)|"
    r"all rights reserved)[^\n]*$"
)


def canonical_lines(text: Column) -> Column:
    """The canonical text with its line breaks; null stays null."""
    out = F.regexp_replace(F.lower(text), _COPYRIGHT_LINES, "")
    for spelling, common in SPELLINGS.items():
        out = F.replace(out, F.lit(spelling), F.lit(common))
    return F.regexp_replace(out, r"[^\p{L}\p{N}\n]+", " ")


def _joined(lines: Column) -> Column:
    return F.trim(F.regexp_replace(lines, r"\s+", " "))


def _digest(form: Column) -> Column:
    return F.when(form != "", F.sha2(form, 256))


def digest(text: Column) -> Column:
    """SHA-256 of the canonical text; null where nothing is left of it."""
    return _digest(_joined(canonical_lines(text)))


def known(spark: SparkSession) -> DataFrame:
    """``digest, licence`` of the known texts and notices."""
    rows = [(name, text) for table in (TEXTS, long_texts(), NOTICES) for name in table for text in table[name]]
    table = spark.createDataFrame(rows, "licence string, text string")
    table = table.select(digest(F.col("text")).alias("digest"), "licence")
    return table.groupBy("digest").agg(F.min("licence").alias("licence"))


def _further(texts: DataFrame) -> DataFrame:
    """``digest, licence`` of a table of ``licence`` and ``text`` or ``digest``."""
    told = F.col("digest") if "digest" in texts.columns else digest(F.col("text"))
    table = texts.select(told.alias("digest"), F.col("licence").cast("string"))
    table = table.where("digest is not null and licence is not null")
    return table.groupBy("digest").agg(F.min("licence").alias("licence"))


def scanned(documents: DataFrame, column: str = "text", texts: DataFrame | None = None) -> DataFrame:
    """The documents with ``licence_digest``, ``licence`` and ``licences_inside``.

    ``licence`` is the known licence that is the whole text, ``licences_inside`` the sorted
    distinct known licences whose text or notice is a line of it. ``texts`` has further
    licences as ``licence`` and ``text`` or ``digest``, the result of ``digest()``; of two
    names of one text the known one counts.
    """
    taken = {"licence_digest", "licence", "licences_inside"} & {c.lower() for c in documents.columns}
    if taken:
        raise ValueError(f"the documents already have {sorted(taken)}")
    table = known(documents.sparkSession)
    lines = F.col("__lines")
    own = documents.select("*", canonical_lines(F.col(f"`{column}`")).alias("__lines"))
    own = own.select(
        *(F.col(f"`{c}`") for c in documents.columns),
        _digest(_joined(lines)).alias("licence_digest"),
        F.transform(F.split(lines, "\n"), lambda x: _digest(F.trim(x))).alias("__digests"),
    )
    # The fixed table once as a joined relation, once as a literal map for the lines.
    whole = F.broadcast(table.select(F.col("digest").alias("licence_digest"), "licence"))
    entries = [F.lit(x) for row in table.collect() for x in (row.digest, row.licence)]
    names = F.create_map(*entries)
    inside = F.transform(
        F.array_intersect("__digests", F.map_keys(names)), lambda d: F.element_at(names, d)
    )
    found = own.join(whole, "licence_digest", "left").withColumn("__inside", inside)
    if texts is not None:
        more = _further(texts).join(F.broadcast(table.select("digest")), "digest", "left_anti")
        found = found.join(
            more.select(F.col("digest").alias("licence_digest"), F.col("licence").alias("__more")),
            "licence_digest",
            "left",
        ).withColumn("licence", F.coalesce("licence", "__more"))
        # Rows of equal lines share a key, so that nothing depends on a number of the row.
        key = F.sha2(F.concat_ws(",", "__digests"), 256)
        found = found.withColumn("__key", key)
        lines_of = own.select(key.alias("__key"), "__digests").dropDuplicates(["__key"])
        lines_of = lines_of.select("__key", F.explode(F.array_distinct("__digests")).alias("digest"))
        met = lines_of.join(more, "digest").groupBy("__key").agg(
            F.collect_set("licence").alias("__met")
        )
        found = found.join(met, "__key", "left").withColumn(
            "__inside",
            F.array_union(
                F.coalesce("__inside", F.array().cast("array<string>")),
                F.coalesce("__met", F.array().cast("array<string>")),
            ),
        )
    return found.select(
        *(F.col(f"`{c}`") for c in documents.columns),
        "licence_digest",
        "licence",
        F.coalesce(
            F.array_sort(F.array_distinct("__inside")), F.array().cast("array<string>")
        ).alias("licences_inside"),
    )
