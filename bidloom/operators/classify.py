"""Ordered keyword rules as data, folded into one CASE expression."""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator, Sequence
from functools import reduce

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .. import schemas as S
from ..functions.text import basename, let

#: (label, groups): every group must have at least one of its words in the text.
Rule = tuple[str, Sequence[Sequence[str]]]

# ---- fixed values: rule order and words -------------------------------------------------------------
FILENAME_RULES: list[Rule] = [
    (S.INVITATION, [["invitation"], ["bid"]]),
    (S.BID_TABS, [["bid tab", "bid_tab", "bidtab"]]),
    (S.AWARD, [["award"], ["letter"]]),
    (S.ITEM_C, [["item c", "item_c", "itemc"]]),
    (S.SUMMARY, [["bid summary", "bidsummary"]]),
    (S.AS_READ, [["bids as read", "bids_as_read"]]),
]
CONTENT_RULES: list[Rule] = [
    (S.INVITATION, [["notice to prospective bidders", "invitation to bid"]]),
    (S.AWARD, [["notification of award", "pleased to inform you that"]]),
    (S.ITEM_C, [["item c"], ["$ totals", "% diff"]]),
    (S.BID_TABS, [["roadway items"], ["bidder", "contractor"]]),
    (S.AS_READ, [["bids as read"]]),
]


def rule_classify(text: Column, rules: Sequence[Rule], default: str = S.UNKNOWN) -> Column:
    """Label of the first rule that holds for the text, which is lower-cased once for all words."""
    def holds(low: Column, groups: Sequence[Sequence[str]]) -> Column:
        any_of = [reduce(Column.__or__, [low.contains(word) for word in group]) for group in groups]
        return reduce(Column.__and__, any_of)

    def first(low: Column) -> Column:
        case = reduce(
            lambda acc, rule: acc.when(holds(low, rule[1]), F.lit(rule[0])), rules[1:],
            F.when(holds(low, rules[0][1]), F.lit(rules[0][0])))
        return case.otherwise(F.lit(default))

    return let(F.lower(text), first)


def classify_filename(path: Column) -> Column:
    return rule_classify(basename(path), FILENAME_RULES)


def classify_content(first_page: Column) -> Column:
    """A document without a first page is unknown."""
    return rule_classify(first_page, CONTENT_RULES)


def document_type(path: Column, first_page: Column) -> Column:
    """File name decides; the page is looked at only when it does not."""
    return let(
        classify_filename(path), lambda by_name: F.when(by_name != S.UNKNOWN, by_name).otherwise(classify_content(first_page)))


def classify(docs: DataFrame) -> DataFrame:
    """Add `document_type` to docs(file_path, first_page, ...)."""
    return docs.withColumn("document_type", document_type(F.col("file_path"), F.col("first_page")))


#: A table of rules is configuration that every task holds: so many words at most.
MOST_WORDS = 500_000
RULE_TABLE = "rule_order int, label string, word_group int, word string"


def rule_rows(spark: SparkSession, rules: Sequence[Rule]) -> DataFrame:
    """A list of rules as a table, one row a word."""
    rows = [(n, label, g, word) for n, (label, word_groups) in enumerate(rules) for g, words in enumerate(word_groups) for word in words]
    return spark.createDataFrame(rows, RULE_TABLE)


class RuleIndex:
    """Rules behind one automaton over all their words, so that a text is read once however many rules there are.

    A rule is looked at only if a word of its rarest group is in the text, rarest by how many rules name its words, so that a word
    that many rules share costs a text nothing."""

    def __init__(self, rows: Sequence[tuple[int, str, int, str]], default: str):
        self.default = default
        self.labels: dict[int, str] = {}
        groups: dict[int, dict[int, set[str]]] = {}
        named: Counter[str] = Counter()
        for order, label, group, word in rows:
            if self.labels.setdefault(order, label) != label:
                raise ValueError(f"rule {order} has two labels")
            groups.setdefault(order, {}).setdefault(group, set()).add(word)
            named[word] += 1
        self.groups = {order: [frozenset(g) for g in by.values()] for order, by in groups.items()}
        self.needs = set(named) - {""}  # every text has the empty word
        self.rules_at: dict[str, list[int]] = {}
        for order in sorted(self.groups):
            for word in min(self.groups[order], key=lambda g: sum(named[w] for w in g)):
                self.rules_at.setdefault(word, []).append(order)
        self.automaton = None

    def words(self, text: str) -> set[str]:
        import ahocorasick

        if self.automaton is None:
            self.automaton = ahocorasick.Automaton()
            for word in self.needs:
                self.automaton.add_word(word, word)
            if self.needs:
                self.automaton.make_automaton()
        return {word for _, word in self.automaton.iter(text)} if self.needs else set()

    def label(self, text: str | None) -> str:
        """Label of the rule with the lowest order all of whose groups have a word in the text."""
        if text is None:
            return self.default
        words = self.words(text) | {""}
        best = None
        for word in words & self.rules_at.keys():
            for order in self.rules_at[word]:
                if best is not None and order >= best:
                    break
                if not any(g.isdisjoint(words) for g in self.groups[order]):
                    best = order
                    break
        return self.default if best is None else self.labels[best]

    def __getstate__(self) -> dict:
        return self.__dict__ | {"automaton": None}  # built again in each worker


def classify_by_table(df: DataFrame, text: str, rules: DataFrame, out: str = "label", default: str = S.UNKNOWN) -> DataFrame:
    """`rule_classify` with the rules of a table (RULE_TABLE): the column `out` is the label of the first rule that holds for the lower-cased
    column `text`.

    A chain of conditions grows with the rules and looks for each word anew; here all words are looked for in one pass over the text. Of
    rules that ask for the same words only the first can win, so only it goes to the tasks, up to MOST_WORDS words in all; more are
    refused. Words are taken as they are, so upper case never matches."""
    rules = rules.select("rule_order", "label", "word_group", "word")
    if not rules.where(reduce(Column.__or__, [F.col(c).isNull() for c in rules.columns])).isEmpty():
        raise ValueError("a rule has a null")
    words = rules.groupBy("rule_order", "word_group").agg(
        F.min("label").alias("low"), F.max("label").alias("high"), F.sort_array(F.collect_set("word")).alias("words"))
    whole = words.groupBy("rule_order").agg(
        F.min("low").alias("label"), F.max("high").alias("other"), F.sort_array(F.collect_set("words")).alias("groups"))
    first = whole.groupBy("groups").agg(
        F.min(F.struct("rule_order", "label")).alias("rule"), F.max(F.when(F.col("label") != F.col("other"), F.col("rule_order"))).alias("twice"))
    rows = [tuple(r) for r in first.select("rule.*", "twice", F.posexplode("groups").alias("word_group", "words")).select(
        "rule_order", "label", "word_group", F.explode("words").alias("word"), "twice").limit(MOST_WORDS + 1).collect()]
    if len(rows) > MOST_WORDS:
        raise ValueError(f"more than {MOST_WORDS} words of rules")
    for *_, twice in rows:
        if twice is not None:
            raise ValueError(f"rule {twice} has two labels")
    rows = [row[:-1] for row in rows]
    index = RuleIndex(rows, default)

    @F.pandas_udf("string")
    def labelled(texts: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for part in texts:
            yield part.map(lambda t: index.label(None if t is None or t is pd.NA else t), na_action=None)

    return df.withColumn(out, labelled(F.lower(text)))
