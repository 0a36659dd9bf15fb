"""SpotSigs document fingerprints, with DataFrame functions only.

A spot signature is a common word (the anchor) with the first content words after it, up to the
next anchor. A document's fingerprint is the set of its spot signatures, so frames and lists that
hold few common words hardly count; only in long stretches without any, chains of all words are added. Sets are partitioned by their number of signatures and are
compared by Jaccard likeness only where the sizes allow the wanted likeness.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window, functions as F

from clinchline.llm.common import partitions, staged

#: Common words of English, French, German and Spanish that anchor signatures.
ANCHORS = (
    "the of and a an to in is was for on with that this be are by at from it as or he she which "
    "le la les un une des du de et en est que qui dans pour par sur au aux avec "
    "der die das und ein eine ist von zu den dem mit sich nicht auf im "
    "el los las una uno del y que se por con para es su al lo"
).split()
#: Content words of a signature.
CHAIN = 2
#: In a stretch of more words than this without an anchor all chains of words count.
SPARSE = 12
_MARK = "\x01"


def any_of(words: list[str]) -> str:
    """A regular expression for these words that reads each letter of a text once."""
    tails: dict[str, list[str]] = {}
    for word in sorted(set(words) - {""}):
        tails.setdefault(word[0], []).append(word[1:])
    branches = "|".join(letter + (any_of(rest) if rest != [""] else "") for letter, rest in tails.items())
    return f"(?:{branches}){'?' if '' in words else ''}"


def signatures(text: Column, anchors: list[str] = ANCHORS, chain: int = CHAIN, sparse: int = SPARSE) -> Column:
    """The ascending distinct 48-bit hashes of a text's spot signatures.

    A stretch, an anchor and the words up to the next one, of more than ``sparse`` words has those of all chains
    of ``chain`` + 1 words in it; so has the stretch before the first anchor. A text without any signature has one, of
    all its words. Equal texts always have equal sets; texts without words (null and empty ones) share the set of
    the empty text. Anchors are words of small letters.
    """
    words = F.concat(F.lit(" "), F.regexp_replace(F.lower(F.coalesce(text, F.lit(""))), r"[^\p{L}\p{N}]+", " "), F.lit(" "))
    stretches = F.split(F.regexp_replace(words, f" (?={any_of(anchors)} )", " " + _MARK), _MARK)
    none = F.array().cast("array<string>")

    def chains(s: Column) -> Column:
        return F.flatten(F.transform(F.array(F.split(s, " ")), lambda listed: F.transform(
            F.sequence(F.lit(1), F.size(listed) - chain), lambda i: F.array_join(F.slice(listed, i, chain + 1), " ")
        )))

    def found(s: Column, i: Column) -> Column:
        spot = F.substring_index(s, " ", chain + 1)
        long = F.substring_index(s, " ", max(sparse, chain)) != s
        return F.when(long, chains(s)).when((i > 0) & s.contains(" "), F.array(spot)).otherwise(F.array().cast("array<string>"))

    low = lambda s: F.conv(F.substring(F.md5(s.cast("binary")), 1, 12), 16, 10).cast("long")
    every = F.array_distinct(F.flatten(F.transform(F.transform(stretches, lambda s: F.trim(s)), found)))
    # as the argument of a lambda the set is made once, though it is used twice
    some = F.transform(F.array(every), lambda e: F.when(F.size(e) > 0, e).otherwise(F.array(F.trim(words))))[0]
    return F.array_sort(F.array_distinct(F.transform(some, low)))


def as_text(sigs: Column) -> Column:
    """A set of signatures as a string: twelve hex digits each."""
    return F.array_join(F.transform(sigs, lambda s: F.lpad(F.lower(F.hex(s)), 12, "0")), "")


def packed(sigs: Column) -> Column:
    """Signatures in six bytes each, for a shuffle: their upper 32 and their lower 16 bits."""
    return F.struct(
        F.transform(sigs, lambda s: (F.shiftright(s, 16) - (1 << 31)).cast("int")).alias("high"),
        F.transform(sigs, lambda s: (s.bitwiseAND(F.lit(0xFFFF)) - (1 << 15)).cast("smallint")).alias("low"),
    )


def unpacked(pack: Column) -> Column:
    return F.zip_with(
        pack["high"], pack["low"],
        lambda h, x: (h.cast("long") + (1 << 31)) * (1 << 16) + x.cast("long") + (1 << 15),
    )


def pruned_jaccard(a: Column, b: Column, floor: float = 0.0) -> Column:
    """Likeness of two sets; 0 without comparing them if their sizes rule out ``floor``."""
    least, most = F.least(F.size(a), F.size(b)), F.greatest(F.size(a), F.size(b))
    both = F.size(F.array_intersect(a, b))
    likeness = both.cast("double") / (F.size(a) + F.size(b) - both)
    return F.when(least < floor * most, F.lit(0.0)).otherwise(likeness)


def following(docs: DataFrame, id_col: str, length: Column) -> DataFrame:
    """(id, previous, previous_length) for every distinct id; the first one follows the last.

    Ids are range-partitioned; only the last id of every partition is seen in one place.
    """
    spark = docs.sparkSession
    ids = docs.where(F.col(id_col).isNotNull()).groupBy(F.col(id_col).alias("id")).agg(F.max(length).alias("length"))
    ranged = staged(
        ids.repartitionByRange(partitions(spark), "id").withColumn("part", F.spark_partition_id()), "ids"
    )
    last = ranged.groupBy("part").agg(F.max(F.struct("id", "length")).alias("last"))
    order = Window.orderBy("part")
    end = Window.orderBy(F.desc("part"))
    before = last.select(
        "part", F.coalesce(F.lag("last").over(order), F.first("last").over(end)).alias("before")
    )
    near = Window.partitionBy("part").orderBy("id")
    return (
        ranged.withColumn("own", F.lag(F.struct("id", "length")).over(near))
        .join(before, "part")
        .select("id", F.coalesce("own", "before").alias("p"))
        .select("id", F.col("p.id").alias("previous"), F.col("p.length").alias("previous_length"))
    )


def fingerprint_changes(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", part: int = 4
) -> DataFrame:
    """Fingerprints of every text and of an edit of it, and how alike they are.

    The edit replaces the last n / ``part`` code points by the first as many of the next document
    by id (after the last comes the first). Returns id, n_chars, edited, sigs, edited_sigs,
    next_sigs and the two likenesses. Null texts are empty. Rows that repeat an id each get a row; as a
    next document the one with the least text counts. A null id has no next document: its edit
    only loses its end, and ``near_next`` is null. Other columns are ignored.
    """
    rows = docs.select(F.col(id_col).alias("id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    links = following(rows, "id", F.length("text"))
    # made once a row, before the exchange that both joins read
    rows = rows.withColumn("sigs", signatures(F.col("text"))).withColumn("sigs", packed(F.col("sigs")))
    least = Window.partitionBy("id").orderBy("text")
    # A left join here too, though every id has a link: both joins then read one exchange of texts.
    heads = (
        rows.join(links, "id", "left")
        .withColumn("n", F.row_number().over(least))
        .where("n = 1")
        .select(
            F.col("previous").alias("id"),
            F.expr(f"substring(text, 1, previous_length div {part})").alias("head"),
            F.col("sigs").alias("next_sigs"),
        )
    )
    n, tail = F.length("text"), F.expr(f"length(text) div {part}")
    return (
        rows.join(heads, "id", "left")
        .select(
            "id",
            n.alias("n_chars"),
            F.concat(
                F.expr(f"substring(text, 1, length(text) - length(text) div {part})"),
                F.coalesce(F.col("head").substr(F.lit(1), tail), F.lit("")),
            ).alias("edited"),
            unpacked(F.col("sigs")).alias("sigs"),
            unpacked(F.col("next_sigs")).alias("next_sigs"),
        )
        .withColumn("edited_sigs", signatures(F.col("edited")))
        .select(
            F.col("id").alias(id_col), F.col("n_chars").cast("long"), "edited", "sigs", "edited_sigs", "next_sigs",
            pruned_jaccard(F.col("sigs"), F.col("edited_sigs")).alias("near_edited"),
            pruned_jaccard(F.col("sigs"), F.col("next_sigs")).alias("near_next"),
        )
    )


def alike_fingerprints(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", threshold: float = 0.8
) -> tuple[DataFrame, DataFrame]:
    """All links between different fingerprints of likeness at or above the threshold.

    Returns (membership: id, class_id) and (links: a, b, likeness) between class ids, the smallest
    ids of documents with equal fingerprints. Sets of n signatures lie in length partition
    ``floor(log n / log(1 / threshold))``; alike ones lie in the same or the next one. There a pair
    is proposed by a shared signature among the rarest ones of both (alike sets must share one),
    and compared if the sizes allow. Rows with a null id are left out; texts that are null or empty
    form a class.
    """
    rows = docs.where(F.col(id_col).isNotNull()).select(F.col(id_col).alias("id"), signatures(F.col(text_col)).alias("sigs"))
    rows = staged(rows.withColumn("key", F.sha2(as_text(F.col("sigs")), 256)), "signatures")
    classes = staged(rows.groupBy("key").agg(F.min("id").alias("class_id"), F.min("sigs").alias("sigs")), "classes")
    membership = rows.join(classes.select("key", "class_id"), "key").select("id", "class_id")
    each = classes.select("class_id", F.size("sigs").alias("n"), F.explode("sigs").alias("sig"))
    ranked = each.join(each.groupBy("sig").agg(F.count("*").alias("df")), "sig")
    rare = Window.partitionBy("class_id").orderBy("df", "sig")
    step = math.log(1 / threshold)
    proposed = (
        ranked.withColumn("rank", F.row_number().over(rare))
        .where(F.col("rank") <= F.col("n") - F.ceil(F.col("n") * threshold - 1e-9) + 1)
        .select("class_id", "sig", "n", F.floor(F.log("n") / step + 1e-9).alias("part"))
    )
    a = proposed.select(F.col("class_id").alias("x"), F.col("n").alias("nx"), "sig", "part")
    b = proposed.select(
        F.col("class_id").alias("y"), F.col("n").alias("ny"), "sig",
        F.explode(F.array("part", F.col("part") - 1)).alias("part"),
    )
    pairs = (
        a.join(b, ["part", "sig"])
        .where((F.least("nx", "ny") >= threshold * F.greatest("nx", "ny") - 1e-9) & (F.col("x") != F.col("y")))
        .select(F.least("x", "y").alias("a"), F.greatest("x", "y").alias("b"))
        .distinct()
    )
    side = lambda s: classes.select(F.col("class_id").alias(s), F.col("sigs").alias(f"sigs_{s}"))
    links = (
        pairs.join(side("a"), "a").join(side("b"), "b")
        .withColumn("likeness", pruned_jaccard(F.col("sigs_a"), F.col("sigs_b"), threshold - 1e-9))
        .where(F.col("likeness") >= threshold - 1e-9)
        .select("a", "b", "likeness")
    )
    return membership, links
