"""Words that stand together: in the same sentence or the one before or behind, within a paragraph."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from corpuloom.operators.ngrams import MOST_BROADCAST, at_least, hint_if_small


def with_context(rows: DataFrame, doc: str = "doc_id", para: str = "para_id", order: str = "sent_id", words: str = "words") -> DataFrame:
    """rows with context: the distinct words of the sentence and its two neighbours in the paragraph."""
    near = Window.partitionBy(doc, para).orderBy(order)
    none = F.array().cast("array<string>")
    around = [F.coalesce(f(words).over(near), none) for f in (F.lag, F.lead)]
    return rows.withColumn("context", F.array_distinct(F.concat(around[0], F.col(words), around[1])))


def with_context_in_document(docs: DataFrame, sentences: str = "sentences") -> DataFrame:
    """The same for documents that hold one paragraph's sentences as array<array<string>>: no shuffle, fit for streams.

    Gives a row a sentence: the other columns, sent_id, words and context.
    """
    others = [c for c in docs.columns if c != sentences]
    near = F.transform(F.col(sentences), lambda w, k: F.struct(w.alias("words"), F.array_distinct(F.flatten(F.slice(F.col(sentences), F.greatest(k, F.lit(1)), F.when(k == 0, 2).otherwise(3)))).alias("context")))
    return docs.select(*others, F.posexplode(near).alias("sent_id", "s")).select(*others, "sent_id", "s.words", "s.context")


def pair_counts(rows: DataFrame, words: str = "words", context: str = "context") -> DataFrame:
    """(w, v, cnt): over all sentences, occurrences of w times whether v is in the context; w itself is in it.

    A sentence's equal words are folded before the pairs are made, and pairs are added up map-side before the shuffle
    on (w, v), so a frequent word is spread over its partners.
    """
    folded = F.transform(F.array_distinct(words), lambda w: F.struct(w.alias("w"), F.size(F.filter(words, lambda x: x == w)).cast("long").alias("m")))
    pairs = rows.select(F.explode(folded).alias("f"), context).select("f.w", "f.m", F.explode(context).alias("v"))
    return pairs.groupBy("w", "v").agg(F.sum("m").alias("cnt"))


def partner_counts(rows: DataFrame, chosen: list[str], words: str = "words", context: str = "context") -> DataFrame:
    """The rows of pair_counts() whose w is one of a few chosen words.

    A sentence's partners are expanded once for all chosen words and added up side by side: one row a partner is
    shuffled, not one a pair, and the rows come parted by v.
    """
    if not chosen:
        return rows.select(F.lit("").alias("w"), F.lit("").alias("v"), F.lit(0).cast("long").alias("cnt")).where("false")
    held = rows.select(F.filter(words, lambda x: x.isin(chosen)).alias("held"), context).where(F.size("held") > 0)

    def times_of(w: str):
        return F.size(F.filter("held", lambda x: x == w))

    times = [times_of(w).alias(f"m{k}") for k, w in enumerate(chosen)]
    sums = held.select(*times, F.explode(context).alias("v")).groupBy("v").agg(*(F.sum(f"m{k}").alias(f"m{k}") for k in range(len(chosen))))
    pairs = F.explode(F.array(*(F.struct(F.lit(w).alias("w"), F.col(f"m{k}").alias("cnt")) for k, w in enumerate(chosen))))
    return sums.select("v", pairs.alias("p")).select("p.w", "v", "p.cnt").where("cnt > 0")


def collocations(rows: DataFrame, doc: str = "doc_id", para: str = "para_id", order: str = "sent_id", words: str = "words") -> DataFrame:
    return pair_counts(with_context(rows, doc, para, order, words), words)


def pruned(rows: DataFrame, unigrams: DataFrame, cutoff: int, keys: tuple[str, ...] = ("doc_id", "para_id", "sent_id"), words: str = "words", most_broadcast: int = MOST_BROADCAST) -> DataFrame:
    """rows with only the words of at least cutoff occurrences, for counts of pairs that a cutoff on both words keeps.

    A pair's count doesn't depend on other words, so this changes none that stays; sentences left empty keep their
    row and part their neighbours as before. unigrams: (word, cnt) of the unpruned words.
    """
    known = hint_if_small(at_least(unigrams, cutoff).select("word"), "word", most_broadcast)
    each = rows.select(*keys, F.posexplode(words).alias("__k", "word")).join(known, "word", "left_semi")
    left = each.groupBy(*keys).agg(F.transform(F.array_sort(F.collect_list(F.struct("__k", "word"))), lambda x: x["word"]).alias("__words"))
    return rows.join(left, list(keys), "left").withColumn(words, F.coalesce("__words", F.array().cast("array<string>"))).drop("__words")
