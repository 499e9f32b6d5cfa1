"""Synthetic short texts from weighted templates over vocabularies."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from kindred import config
from kindred.operators.numbering import first_rows
from kindred.session import materialize

MAX_VOCABULARY = 100_000


@dataclass(frozen=True)
class Template:
    """Names of the vocabularies a text is made of, and how often it is used
    relative to the others."""

    slots: tuple[str, ...]
    weight: int = 1


def vocabulary(df: DataFrame, word: Column) -> list[str]:
    """Distinct words of a column in order; a vocabulary is a parameter of the
    generator and has to stay small."""
    words = df.select(word.alias("word")).filter(F.col("word").isNotNull()).distinct().orderBy("word")
    found = [row["word"] for row in words.limit(MAX_VOCABULARY + 1).collect()]
    if len(found) > MAX_VOCABULARY:
        raise ValueError(f"more than {MAX_VOCABULARY} distinct words")
    return found


def draw(seed: int, row: Column, purpose: str, size: int) -> Column:
    """Number in 0..size-1 that depends only on seed, row number and purpose."""
    digest = F.md5(F.concat_ws(":", F.lit(str(seed)), row.cast("string"), F.lit(purpose)))
    return F.conv(F.substring(digest, 1, 8), 16, 10).cast("bigint") % size


def sample_texts(
    spark: SparkSession, n: int, vocabularies: dict[str, list[str]], templates: list[Template], seed: int
) -> DataFrame:
    """``row, text`` for rows 0..n-1; texts may repeat. Narrow: no shuffle."""
    row = F.col("row")
    total = sum(t.weight for t in templates)
    slot_number = draw(seed, row, "template", total)
    text = F.lit(None).cast("string")
    upto = total
    for number in range(len(templates) - 1, -1, -1):
        template = templates[number]
        words = []
        for place, slot in enumerate(template.slots):
            choice = draw(seed, row, str(place), len(vocabularies[slot]))
            words.append(F.element_at(F.array(*[F.lit(w) for w in vocabularies[slot]]), (choice + 1).cast("int")))
        text = F.when(F.col("slot") < upto, F.concat_ws(" ", *words)).otherwise(text) if number < len(templates) - 1 else F.concat_ws(" ", *words)
        upto -= template.weight
    return spark.range(n).select(F.col("id").alias("row")).withColumn("slot", slot_number).select("row", text.alias("text"))


def generate_texts(
    spark: SparkSession,
    count: int,
    vocabularies: dict[str, list[str]],
    templates: list[Template],
    *,
    seed: int = config.GENERATOR_SEED,
    max_rounds: int = 8,
    draws: int | None = None,
) -> DataFrame:
    """``pos, text``: the first ``count`` distinct texts of the sample sequence.

    More rows than needed are drawn and reduced to distinct texts (kept at
    their first row); a round that falls short draws four times as many. A
    request beyond what the templates can express is an error, not an endless
    loop. With ``draws`` the sequence ends after so many rows, and a request
    beyond what they hold gets all their distinct texts.
    """
    space = sum(_combinations(t, vocabularies) for t in templates)
    if draws is None and count > space:
        raise ValueError(f"{count} distinct texts asked for, the templates make at most {space}")
    drawn = max(2 * count, 16)
    for _ in range(max_rounds):
        last = draws is not None and (drawn >= draws or count > space)
        sample = sample_texts(spark, draws if last else drawn, vocabularies, templates, seed)
        distinct = materialize(sample.groupBy("text").agg(F.min("row").alias("row")), "texts")
        if last or distinct.count() >= count:
            return first_rows(distinct, count, "row").select("pos", "text")
        drawn *= 4
    raise ValueError(f"no {count} distinct texts among {drawn // 4} drawn ones")


def _combinations(template: Template, vocabularies: dict[str, list[str]]) -> int:
    product = 1
    for slot in template.slots:
        product *= len(vocabularies[slot])
    return product
