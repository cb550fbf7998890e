"""Made-up inputs: a gold set, vectors that drift, a list of sources."""

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# The labels and difficulties of the gold set.
GOLD_LOGOS = ("nike", "adidas", "under_armour", "puma", "jordan", "reebok", "new_balance", "gatorade", "espn")
GOLD_FACES = ("lebron_james", "stephen_curry", "kevin_durant")
DIFFICULTIES = ("easy", "partial_occlusion", "blur", "small")


def gold_samples(spark: SparkSession, each: int = 50) -> DataFrame:
    """(sample_id, true_label, entity_type, difficulty): so many rows of each label; the difficulty by hash of the id."""
    labels = spark.createDataFrame([(x, "logo") for x in GOLD_LOGOS] + [(x, "face") for x in GOLD_FACES], "true_label string, entity_type string")
    rows = labels.withColumn("i", F.explode(F.sequence(F.lit(0), F.lit(each - 1))))
    sample = F.format_string("gold_%s_%03d", "true_label", "i")
    hard = F.element_at(F.array(*map(F.lit, DIFFICULTIES)), (F.pmod(F.xxhash64(sample), F.lit(len(DIFFICULTIES))) + 1).cast("int"))
    return rows.select(sample.alias("sample_id"), "true_label", "entity_type", hard.alias("difficulty"))


def drift_vectors(spark: SparkSession, rows: int, dim: int, shift: float = 0.0, seed: int = 99) -> DataFrame:
    """(id, embedding): normal values by hash of row and place; with a shift, so many deviations of other ones are added."""
    unit = lambda s, i: (F.pmod(F.xxhash64("id", i, F.lit(s)), F.lit(1 << 40)).cast("double") + 0.5) / float(1 << 40)
    normal = lambda s, i: F.sqrt(-2 * F.ln(unit(s, i))) * F.cos(2 * F.pi() * unit(s + 1, i))
    value = F.transform(F.sequence(F.lit(1), F.lit(dim)), lambda i: normal(seed, i) + F.lit(shift) * normal(seed + 2, i))
    return spark.range(rows).select("id", value.alias("embedding"))


def sources(spark: SparkSession, names: list[str]) -> DataFrame:
    return spark.createDataFrame([(n,) for n in names], "source string")


def stem(path: str) -> Column:
    """A path's last part without its last ending."""
    return F.regexp_extract(path, r"([^/]*?)(\.[^./]*)?$", 1)
