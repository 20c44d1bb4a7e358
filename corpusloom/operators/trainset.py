"""question/answer pairs, chat messages, chat text and curation."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from corpusloom.config import Curation, Quality
from corpusloom.functions import text as tx
from corpusloom.functions.hold import hold

Generator = Callable[[str, int], list[tuple[str, str]]]

# The plain chat format.
PLAIN_LABELS = (("system", "System: "), ("user", "User: "), ("assistant", "Assistant: "))
TEMPLATE_ROLES = ("system", "user", "assistant")
DEFAULT_TEMPLATE = "<|{role}|>\n{content}\n"
ROWS_AT_ONCE = 1000
SYSTEM_PROMPT = "You are a helpful assistant."


def first_chunks(chunks: DataFrame, max_chunks: int | None) -> DataFrame:
    """The first chunks of every document: the index is dense, so a filter does."""
    return chunks if not max_chunks else chunks.filter(F.col("chunk_index") < max_chunks)


def extracted_pairs(content: Column, count: int) -> Column:
    """Pairs without a model: each sentence answers a question on its opening words."""
    parts = F.transform(F.split(content, r"(?<=[.!?])\s+"), tx.strip)
    sentences = F.slice(F.filter(parts, lambda s: s != ""), 1, count)

    def pair(sentence: Column, position: Column) -> Column:
        opening = F.array_join(F.slice(tx.words(sentence), 1, 3), " ")
        topic = F.regexp_replace(opening, "[.!?,]+$", "")
        question = F.concat(F.lit("What does the text say about "), topic, F.lit("?"))
        return F.struct(position.alias("pair_index"), question.alias("question"), sentence.alias("answer"))

    return F.transform(sentences, pair)


def generate_pairs(
    chunks: DataFrame,
    make_generator: Callable[[], Generator] | None = None,
    num_pairs: int = 25,
    max_chunks: int | None = None,
) -> DataFrame:
    """(chunk_id, pair_index, question, answer, error), up to ``num_pairs`` per chunk.

    ``make_generator`` runs once per task, to load a model there; without one the
    sentences themselves are the answers. A chunk whose generation fails gives
    one row with its error and no pair.
    """
    chosen = first_chunks(chunks, max_chunks).select("chunk_id", "content")
    if make_generator is None:
        made = chosen.select("chunk_id", F.explode(extracted_pairs(F.col("content"), num_pairs)).alias("p"))
        return made.select("chunk_id", "p.*", F.lit(None).cast("string").alias("error"))

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        generator = make_generator()
        for batch in batches:
            rows = []
            for chunk_id, content in zip(batch["chunk_id"], batch["content"]):
                try:
                    made = generator(content, num_pairs)
                    rows += [(chunk_id, i, q, a, None) for i, (q, a) in enumerate(made)]
                except Exception as problem:  # noqa: BLE001 - any failure becomes a row
                    rows.append((chunk_id, None, None, None, str(problem)))
                if len(rows) >= ROWS_AT_ONCE:
                    yield pair_frame(rows)
                    rows = []
            yield pair_frame(rows)

    return chosen.mapInPandas(
        run, "chunk_id string, pair_index int, question string, answer string, error string"
    )


def pair_frame(rows: list[tuple]) -> pd.DataFrame:
    columns = ["chunk_id", "pair_index", "question", "answer", "error"]
    return pd.DataFrame(rows, columns=columns).astype({"pair_index": "Int32"})


def message(role: str, content: Column) -> Column:
    return F.struct(F.lit(role).alias("role"), content.alias("content"))


def to_messages(pairs: DataFrame, system_prompt: str = SYSTEM_PROMPT) -> DataFrame:
    """Each question/answer pair as a three-message conversation; failed rows go."""
    if "error" in pairs.columns:
        pairs = pairs.filter("error is null").drop("error")
    conversation = F.array(
        message("system", F.lit(system_prompt)),
        message("user", F.col("question")),
        message("assistant", F.col("answer")),
    )
    return pairs.withColumn("messages", conversation).drop("question", "answer")


def conversations(turns: DataFrame, key: str = "conv_id") -> DataFrame:
    """(key, messages) from one row per turn; a conversation is one value, as it is used."""
    turn = F.struct("turn", "role", F.col("text").alias("content"))
    ordered = F.array_sort(F.collect_list(turn))
    return turns.groupBy(key).agg(
        F.transform(ordered, lambda t: F.struct(t["role"], t["content"])).alias("messages")
    )


def plain_text(messages: Column) -> Column:
    """Labelled lines; messages of other roles are dropped, a missing role is the user."""

    def line(m: Column) -> Column:
        role = F.coalesce(m["role"], F.lit("user"))
        body = F.coalesce(m["content"], F.lit(""))
        text = F.lit("")
        for name, label in reversed(PLAIN_LABELS):
            text = F.when(role == name, F.concat(F.lit(label), body, F.lit("\n"))).otherwise(text)
        return text

    return F.array_join(F.transform(messages, line), "")


def templated_text(messages: Column, template: str = DEFAULT_TEMPLATE) -> Column:
    """Messages through a template string; the plain form if a role is not known to it."""

    def render(m: Column) -> Column:
        with_role = F.replace(F.lit(template), F.lit("{role}"), m["role"])
        return F.replace(with_role, F.lit("{content}"), F.coalesce(m["content"], F.lit("")))

    fits = F.forall(messages, lambda m: F.coalesce(m["role"].isin(*TEMPLATE_ROLES), F.lit(False)))
    rendered = F.array_join(F.transform(messages, render), "")
    return F.when(fits, rendered).otherwise(plain_text(messages))


def chat_dataset(rows: DataFrame, template: str | None = None) -> DataFrame:
    """A single ``text`` column; everything else is dropped."""
    messages = F.col("messages")
    text = plain_text(messages) if template is None else templated_text(messages, template)
    return rows.select(text.alias("text"))


def answer_fits(answer: Column, rules: Curation = Curation()) -> Column:
    """Answer length in characters, bounds included."""
    return F.length(answer).between(rules.min_answer, rules.max_answer)


def curate(
    pairs: DataFrame,
    key: str,
    rules: Curation = Curation(),
    quality: Quality = Quality(),
) -> DataFrame:
    """The best ``max_examples`` answers at or above the threshold, ties by key."""
    scored = hold(pairs, "score", tx.quality_score(F.col("answer"), quality.filters))
    return (
        scored.filter(F.col("score") >= F.lit(rules.threshold))
        .orderBy(F.desc("score"), key)
        .limit(rules.max_examples)
    )


def fits_bounds(pairs: DataFrame, rules: Curation = Curation()) -> DataFrame:
    """Answer length bounds and, where given, the allowed question types."""
    kept = pairs.filter(answer_fits(F.col("answer"), rules))
    if "question_type" in pairs.columns:
        kept = kept.filter(F.col("question_type").isin(*rules.question_types))
    return kept


def dataset_union(*parts: DataFrame) -> DataFrame:
    """All parts by column name; columns a part lacks are null."""
    whole, *others = parts
    for part in others:
        whole = whole.unionByName(part, allowMissingColumns=True)
    return whole


def dataset_stats(
    examples: DataFrame, chunks: int | None, pairs_per_chunk: int, source: str
) -> DataFrame:
    return examples.agg(
        F.count(F.lit(1)).alias("total_examples"),
        F.lit("all" if chunks is None else str(chunks)).alias("chunks_processed"),
        F.lit(pairs_per_chunk).alias("pairs_per_chunk"),
        F.lit(source).alias("input_source"),
    )
