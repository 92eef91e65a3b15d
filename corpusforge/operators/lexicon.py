"""Lexicons from a corpus, affix expansion and restoring lost marks."""

from __future__ import annotations

import re

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from corpusforge.functions import text as T
from corpusforge.operators.components import cut_lineage
from corpusforge.session import small


def tokens(docs: DataFrame, id: str = "doc_id", text: str = "text") -> DataFrame:
    """(id, pos, form, k, prev, next): surface words, their folded keys and their neighbours' keys."""
    # Folding maps letter to letter and leaves blanks alone, so a document's words are folded in one go.
    rows = docs.select(F.col(id).alias("id"), T.surface_words(F.col(text)).alias("w"))
    rows = rows.select("id", "w", F.split(T.fold(F.array_join("w", " ")), " ").alias("ks")).select("id", "ks", F.posexplode("w").alias("pos", "form"))
    at = lambda i: F.get("ks", i)
    return rows.select("id", "pos", "form", at(F.col("pos")).alias("k"), F.when(F.col("pos") > 0, at(F.col("pos") - 1)).alias("prev"), at(F.col("pos") + 1).alias("next"))


def priors(tokens: DataFrame) -> DataFrame:
    """(k, form, n). A form has one key, so forms are counted before they are folded."""
    return tokens.groupBy("form").agg(F.count("*").alias("n")).select(T.fold(F.col("form")).alias("k"), "form", "n")


def contexts(tokens: DataFrame, side: str) -> DataFrame:
    """(k, side, form, n) for side = prev or next."""
    return tokens.filter(F.col(side).isNotNull()).groupBy(side, "form").agg(F.count("*").alias("n")).select(T.fold(F.col("form")).alias("k"), side, "form", "n")


def dominant(counts: DataFrame, by: list[str], least: int = 1, num: int = 8, den: int = 10) -> DataFrame:
    """By + (form, n, total): the form that has at least num / den of at least `least` sightings."""
    top = counts.groupBy(*by).agg(F.sum("n").alias("total"), F.max_by(F.struct("form", "n"), F.struct("n", "form")).alias("top"))
    return top.select(*by, F.col("top.form").alias("form"), F.col("top.n").alias("n"), "total").filter((F.col("total") >= least) & (F.col("n") * den >= F.col("total") * num))


#: Outcomes that only neighbours can settle; up to this many keys of theirs are handed to all tasks, as hashes.
OPEN, PICKED = ("listed", "free"), 1 << 20


def verdicts(counts: DataFrame, listed: DataFrame) -> DataFrame:
    """(k, outcome, chosen): what corpus counts (k, form, n) and different dictionary forms (k, form) say of each key; the rest is OPEN."""
    forms = listed.groupBy("k").agg(F.count("*").alias("forms"), F.min("form").alias("only"))
    by_dict = dominant(counts.join(listed, ["k", "form"]), ["k"]).select("k", F.col("form").alias("by_dict"))
    by_corpus = counts.select("k").distinct().join(dominant(counts, ["k"]).select("k", F.col("form").alias("by_corpus")), "k", "left")
    verdict = lambda outcome, form=F.lit(None).cast("string"): F.struct(F.lit(outcome).alias("outcome"), form.alias("form"))
    settled = (
        F.when(F.col("forms") == 1, verdict("unique", F.col("only")))
        .when(F.col("by_dict").isNotNull(), verdict("dominant", F.col("by_dict")))
        .when(F.col("forms") > 1, verdict("listed"))
        .when(F.col("by_corpus").isNotNull(), verdict("corpus", F.col("by_corpus")))
        .otherwise(verdict("free"))
    )
    return by_corpus.join(forms.join(by_dict, "k", "left"), "k", "full").select("k", settled.alias("v")).select("k", "v.outcome", F.col("v.form").alias("chosen"))


def by_context(rows: DataFrame, corpus: DataFrame, listed: DataFrame) -> DataFrame:
    """Rows (k, prev, next, outcome) of OPEN keys with the form that dominates beside a neighbour in the corpus's sightings of these keys (chosen), and the outcome after that."""
    left = dominant(contexts(corpus, "prev"), ["k", "prev"], 3).select("k", "prev", F.col("form").alias("by_left"))
    right = dominant(contexts(corpus, "next"), ["k", "next"], 3).select("k", "next", F.col("form").alias("by_right"))
    near = rows.join(left, ["k", "prev"], "left").join(right, ["k", "next"], "left").withColumn("chosen", F.coalesce("by_left", "by_right"))
    near = near.join(listed.select("k", F.col("form").alias("chosen"), F.lit(True).alias("is_listed")), ["k", "chosen"], "left")
    near = near.withColumn("chosen", F.when((F.col("outcome") == "free") | F.col("is_listed"), F.col("chosen")))
    return near.withColumn("outcome", F.when(F.col("chosen").isNotNull(), "context").otherwise("ambiguous"))


def written():
    """The form to write: the chosen one if it is as long as the key, else the key."""
    return F.when(F.length("chosen") == F.length("k"), F.col("chosen")).otherwise(F.col("k"))


def restore(targets: DataFrame, corpus: DataFrame, dictionary: DataFrame, carry: list[str] | None = None) -> DataFrame:
    """For each target (id, pos, k, prev, next) the form to write and the outcome; columns named in carry come along.

    A key with one dictionary form takes it (unique). With several, the one that has at least 0.8 of the corpus's sightings of these
    forms (dominant). Without any, the form that has 0.8 of all sightings of the key (corpus). Where that doesn't decide, the form that
    dominates beside the left neighbour, else beside the right one, each from three sightings on (context); if the dictionary has the key,
    it must have that form. Otherwise nothing is written (ambiguous), nor for a key that corpus and dictionary lack (unknown).
    A form of another length than the key is not written. dictionary: (k, form).

    All but the contexts is settled once per key. Contexts are counted for the open keys alone, and only their targets look them up.
    """
    listed = dictionary.select("k", "form").distinct()
    told = verdicts(priors(corpus), listed)
    open_ = F.col("outcome").isin(*OPEN)
    rows = targets.join(told, "k", "left").withColumn("outcome", F.coalesce("outcome", F.lit("unknown")))
    near = by_context(rows.filter(open_).drop("chosen"), corpus.join(told.filter(open_).select("k"), "k", "left_semi"), listed)
    kept = ["id", "pos", "k", *(carry or []), "outcome", "chosen"]
    every = rows.filter(~open_).select(kept).unionAll(near.select(kept))
    return every.select("id", "pos", "k", *(carry or []), written().alias("form"), "outcome")


def restored_counts(corpus: DataFrame, counts: DataFrame, dictionary: DataFrame) -> DataFrame:
    """(outcome, n, correct): how restore does on the corpus's own tokens, whose forms are the truth. counts are the corpus's priors.

    Sightings of settled keys are told by the counts; only tokens of OPEN keys are rows, and move."""
    listed = dictionary.select("k", "form").distinct()
    told = cut_lineage(verdicts(counts, listed))
    unsettled, settled = told.filter(F.col("outcome").isin(*OPEN)).select("k", "outcome"), told.filter(~F.col("outcome").isin(*OPEN))
    tokens = corpus.select("k", "form", "prev", "next")
    hashes = unsettled.select(F.xxhash64("k").alias("h"))
    if hashes.limit(PICKED + 1).count() <= PICKED:  # leaves few others, by equal hashes
        tokens = tokens.withColumn("h", F.xxhash64("k")).join(F.broadcast(hashes), "h", "left_semi").drop("h")
    seen = cut_lineage(tokens.join(unsettled.hint("merge"), "k"))
    near = by_context(seen.withColumnRenamed("form", "truth"), seen, listed).select("outcome", F.col("truth"), written().alias("form"), F.lit(1).cast("long").alias("n"))
    known = counts.withColumnRenamed("form", "truth").join(settled, "k").select("outcome", "truth", written().alias("form"), "n")
    return known.unionAll(near).groupBy("outcome").agg(F.sum("n").alias("n"), F.coalesce(F.sum(F.when(F.col("form") == F.col("truth"), F.col("n"))), F.lit(0)).cast("long").alias("correct"))


def rebuild(restored: DataFrame) -> DataFrame:
    """(id, text): restored words in their order, joined by blanks."""
    return restored.groupBy("id").agg(F.array_join(F.transform(F.sort_array(F.collect_list(F.struct("pos", "form"))), lambda x: x["form"]), " ").alias("text"))


def coverage(docs: DataFrame, dictionary: DataFrame, id: str = "doc_id", words: str = "words", first: int = 40, longer: int = 2) -> DataFrame:
    """How many of the first 40 words longer than two letters the dictionary (word) has."""
    w = F.slice(F.filter(words, lambda x: F.length(x) > longer), 1, first)
    rows = docs.select(F.col(id).alias("id"), F.explode_outer(w).alias("word"))
    known = dictionary.select("word").distinct().withColumn("known", F.lit(1))
    return rows.join(known, "word", "left").groupBy("id").agg(F.count("word").alias("n"), F.count("known").alias("known"))


def load_affixes(rows: DataFrame) -> DataFrame:
    """Rules (kind, flag, strip, add, cond) from affix lines; headers and rules whose condition is no pattern are left out."""
    f = F.split(F.trim("value"), r"\s+")
    rule = rows.filter(F.col("value").rlike(r"^(SFX|PFX)\s")).select(f.alias("f")).filter(F.size("f") >= 5)
    bare = lambda i: F.when(F.get("f", F.lit(i)) == "0", "").otherwise(F.split(F.get("f", F.lit(i)), "/")[0])
    out = rule.select(F.get("f", F.lit(0)).alias("kind"), F.get("f", F.lit(1)).alias("flag"), bare(2).alias("strip"), bare(3).alias("add"), F.get("f", F.lit(4)).alias("cond"))

    def good(cond: str) -> bool:
        try:
            return bool(re.compile(cond))
        except re.error:
            return False

    bad = [r.cond for r in out.select("cond").distinct().collect() if not good(r.cond)]  # rules are a small, curated file
    return out.filter(~F.col("cond").isin(bad)) if bad else out


def expand(stems: DataFrame, rules: DataFrame) -> DataFrame:
    """Every form of stems (word, flags): suffixes on the stem, then prefixes on the stem and its suffixed forms."""
    flags = stems.select("word", F.explode(F.filter(F.split(F.coalesce("flags", F.lit("")), ""), lambda x: x != "")).alias("flag"))
    rules = small(rules)
    suffix = flags.join(rules.filter("kind = 'SFX'"), "flag").filter(F.expr("word rlike concat('(?:', cond, ')$') and endswith(word, strip)"))
    suffixed = suffix.select("word", F.expr("concat(substring(word, 1, length(word) - length(strip)), add)").alias("form"))
    base = stems.select("word", F.col("word").alias("form")).unionAll(suffixed)
    prefix = base.join(flags, "word").join(rules.filter("kind = 'PFX'"), "flag").filter(F.expr("form rlike concat('^(?:', cond, ')') and startswith(form, strip)"))
    prefixed = prefix.select("word", F.expr("concat(add, substring(form, length(strip) + 1, length(form)))").alias("form"))
    return base.unionAll(prefixed).select("form").filter(~F.col("form").rlike(r"^\d")).distinct()


def with_neighbours(rows: DataFrame, partition: str, order: str, key: str) -> DataFrame:
    w = Window.partitionBy(partition).orderBy(order)
    return rows.withColumn("prev", F.lag(key).over(w)).withColumn("next", F.lead(key).over(w))
