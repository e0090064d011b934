r"""Merkle fingerprints of documents.

A text is split, without loss, into paragraphs that end with their line feed. A
paragraph whose digest starts with 0 to 3 (one in four) closes a section, so an edit
moves section borders only near itself. The section digest is the MD5 of its paragraph
digests, the root the first half of the SHA-256 of the section digests. Below each
paragraph hang short codes of its units (up to four words, ending at a sentence end),
which tell how much of a changed paragraph is still the same.

    fingerprint = root "|" section (";" section)*
    section     = digest "/" paragraph ("," paragraph)*
    paragraph   = digest ":" code ("." code)*

Roots are equal when texts are equal; where they differ, comparing section digests and
then the paragraph digests of the differing sections locates the edits
(``changed_paragraphs``). ``likeness`` is the Dice share of common unit codes.

Defined cases: a null text is the empty text, whose fingerprint is that of one empty
paragraph; words longer than 64 code points count as several; two texts without any
word have likeness 1 when their fingerprints are equal, else 0. Rows that share doc_id
and text are one document in the order of documents, and each row is returned. A null
doc_id comes first. An empty table gives no rows; a single document follows itself.
Other columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from airstrata.operators.ordering import global_index
from airstrata.session import materialize

# white space is spelled out, so that other engines read the patterns alike
PARAGRAPH = "[^\n]*\n|[^\n]+"
UNIT = (
    r"(?:[^ \t\n\f\r]{0,63}[^ \t\n\f\r.!?][ \t\n\f\r]+){0,3}"
    r"[^ \t\n\f\r]{1,64}[ \t\n\f\r]*"
)
_DIGEST, _CODE = 8, 6


def fingerprint(text: Column) -> Column:
    whole = F.coalesce(text, F.lit(""))
    found = F.regexp_extract_all(whole, F.lit(PARAGRAPH), F.lit(0))
    paragraphs = F.when(F.size(found) > 0, found).otherwise(F.array(F.lit("")))

    def paragraph(part: Column) -> Column:
        digest = F.md5(part)
        units = F.regexp_extract_all(part, F.lit(UNIT), F.lit(0))
        codes = F.array_join(F.transform(units, lambda u: F.substring(F.md5(u), 1, _CODE)), ".")
        closes = F.substring(digest, 1, 1) < "4"
        return F.concat(
            F.substring(digest, 1, _DIGEST), F.lit(":"), codes, F.when(closes, F.lit(";")).otherwise(F.lit(","))
        )

    marked = F.array_join(F.transform(paragraphs, paragraph), "")
    # without its last sign, which is one comma or semicolon
    sections = F.split(F.rtrim(marked, F.lit(",;")), ";")

    def section(part: Column) -> Column:
        digests = F.regexp_replace(part, r":[0-9a-f.]*", "")
        return F.concat(F.substring(F.md5(digests), 1, _DIGEST), F.lit("/"), part)

    body = F.array_join(F.transform(sections, section), ";")
    root = F.substring(F.sha2(F.concat(F.md5(whole), F.regexp_replace(body, r"/[^;]*", "")), 256), 1, 32)
    return F.concat(root, F.lit("|"), body)


def root(print_: Column) -> Column:
    return F.substring(print_, 1, 32)


def _codes(print_: Column) -> Column:
    """The distinct unit codes of a fingerprint."""
    bare = F.regexp_replace(print_, r"\A[0-9a-f]*\||[0-9a-f]{8}/|[0-9a-f]{8}:", "")
    return F.array_distinct(F.array_remove(F.split(bare, "[.,;]"), ""))


def likeness(left: Column, right: Column, codes: tuple[Column, Column] | None = None) -> Column:
    """Dice share of the unit codes that two fingerprints have in common, 0 to 1.

    ``codes`` are the distinct codes of both, where they are columns of their own already;
    as expressions they are worked out at each use.
    """
    a, b = codes or (_codes(left), _codes(right))
    common = F.size(F.array_intersect(a, b))
    share = 2.0 * common / F.nullif(F.size(a) + F.size(b), F.lit(0))
    return F.when(left == right, F.lit(1.0)).otherwise(F.coalesce(share, F.lit(0.0)))


def changed_paragraphs(old: Column, new: Column) -> Column:
    """Numbers, from 0, of the paragraphs of ``new`` that ``old`` does not have.

    Sections that both have are passed over as wholes.
    """

    def sections(print_: Column) -> Column:
        return F.split(F.substring(print_, F.lit(34), F.length(print_)), ";")

    kept = F.transform(sections(old), lambda s: F.substring(s, 1, _DIGEST))
    known = F.transform(
        F.flatten(F.transform(sections(old), lambda s: F.split(F.substring(s, F.lit(10), F.length(s)), ","))),
        lambda p: F.substring(p, 1, _DIGEST),
    )
    marks = F.flatten(
        F.transform(
            sections(new),
            lambda s: F.transform(
                F.split(F.substring(s, F.lit(10), F.length(s)), ","),
                lambda p: ~F.array_contains(kept, F.substring(s, 1, _DIGEST))
                & ~F.array_contains(known, F.substring(p, 1, _DIGEST)),
            ),
        )
    )
    places = F.transform(marks, lambda changed, at: F.when(changed, at))
    return F.array_compact(places)


def fingerprint_edits(documents: DataFrame) -> DataFrame:
    """Fingerprints of every text and of its edited text.

    The edited text has its last quarter of code points replaced by the beginning of the
    next document in doc_id order (the first follows the last). Texts are shuffled once,
    by document, and printed behind that shuffle; only the requested beginnings and the
    fingerprints of the next documents move a second time.
    """
    texts = documents.select("doc_id", F.coalesce("text", F.lit("")).alias("text"))
    # names a document by id and text, without null
    name = F.md5(F.concat_ws(":", F.coalesce(F.col("doc_id").cast("string"), F.lit("null")), "text"))
    keyed = texts.withColumn("key", name)
    order = global_index(
        keyed.select("doc_id", "key", F.length("text").alias("n")).distinct(), ["doc_id", "key"], "at"
    )
    order = materialize(order, "order")
    total = order.count()
    asks = order.select(
        F.col("key").alias("to_key"), "n", ((F.col("at") + 1) % F.lit(max(total, 1))).alias("next_at")
    )
    after = order.select(F.col("key").alias("from_key"), "at")
    asks = asks.join(after, asks["next_at"] == after["at"]).drop("at", "next_at")
    lent = keyed.join(asks, keyed["key"] == asks["from_key"]).select(
        "to_key",
        F.col("doc_id").alias("next_doc_id"),
        F.substring("text", F.lit(1), F.floor(F.col("n") / 4).cast("int")).alias("lent"),
        fingerprint(F.col("text")).alias("next_print"),
    )
    # both joins read the same columns of the texts, so that Spark shuffles these once
    both = keyed.join(lent.dropDuplicates(["to_key"]), F.col("key") == F.col("to_key"))
    both = both.withColumn("print", fingerprint(F.col("text")))
    n = F.length("text")
    edited = F.concat(
        F.substring("text", F.lit(1), (n - F.floor(n / 4)).cast("int")), F.col("lent")
    )
    both = both.select("doc_id", "text", "print", "next_print", "next_doc_id", edited.alias("edited"))
    both = both.withColumn("edited_print", fingerprint(F.col("edited")))
    prints = {"codes": "print", "edited_codes": "edited_print", "next_codes": "next_print"}
    both = both.withColumns({name: _codes(F.col(of)) for name, of in prints.items()})
    return both.select(
        "doc_id",
        F.length("text").cast("long").alias("n_chars"),
        F.sha2("edited", 256).alias("edited_sha256"),
        F.col("print").alias("fingerprint"),
        F.col("edited_print").alias("edited_fingerprint"),
        likeness(F.col("print"), F.col("edited_print"), (F.col("codes"), F.col("edited_codes"))).alias("near_edited"),
        likeness(F.col("print"), F.col("next_print"), (F.col("codes"), F.col("next_codes"))).alias("near_next"),
        "next_doc_id",
    )
