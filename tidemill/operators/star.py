"""Star-schema build: cleaning, dimensions, surrogate keys, load and lookups."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemill.functions.scalars import length_of_stay, money, title_case
from tidemill.operators.ordering import global_index
from tidemill.session import cut

TITLED = ("patient_name", "gender", "condition", "doctor", "admission_type", "result")
STRIPPED = ("hospital", "insurer")
DIMENSIONS = (
    ("doctor", "doctor_id", "doctors"), ("hospital", "hospital_id", "hospitals"), ("insurer", "provider_id", "insurance_providers"),
)


def clean_admissions(flat: DataFrame) -> DataFrame:
    """Trim and title-case the text, derive the stay, round the bill, then drop exact duplicates."""
    text = {c: title_case(F.trim(F.col(c))) for c in TITLED} | {c: F.trim(F.col(c)) for c in STRIPPED}
    derived = flat.withColumns(text).withColumns(
        {"billing": money("billing"), "stay_days": length_of_stay("admitted", "discharged")}
    )
    return derived.dropDuplicates()


def build_dimension(df: DataFrame, column: str, key: str) -> DataFrame:
    """Sorted distinct names with ids from 1."""
    names = df.select(F.col(column).alias("name")).filter(F.col("name").isNotNull()).distinct()
    return global_index(names, "name", name=key, start=1).select(key, "name")


def attach_key(fact: DataFrame, column: str, dim: DataFrame, key: str) -> DataFrame:
    """Replace a name by its surrogate key; an unknown name gives null.

    No hint: the planner broadcasts the dimension when its measured size allows it.
    """
    lookup = dim.select(F.col(key), F.col("name").alias("__name"))
    return fact.join(lookup, F.col(column) == F.col("__name"), "left").drop("__name", column)


@dataclass
class Star:
    """Written tables of one load."""

    root: str
    admissions: DataFrame
    doctors: DataFrame
    hospitals: DataFrame
    insurers: DataFrame

    def counts(self) -> DataFrame:
        """Rows per loaded table."""
        parts = [
            df.agg(F.count(F.lit(1)).alias("rows")).select(F.lit(name).alias("table"), "rows")
            for name, df in (
                ("admissions", self.admissions), ("doctors", self.doctors),
                ("hospitals", self.hospitals), ("insurance_providers", self.insurers),
            )
        ]
        out = parts[0]
        for part in parts[1:]:
            out = out.unionByName(part)
        return out


def load_star(flat: DataFrame, root: str) -> Star:
    """Full refresh: write the dimensions and the fact under `root`, replacing what is there.

    The dimensions are written first and looked up from their tables, whose sizes are known:
    small ones are broadcast to the fact, a big one (doctors) is joined by shuffle.
    """
    spark: SparkSession = flat.sparkSession

    def store(df: DataFrame, name: str) -> DataFrame:
        df.write.mode("overwrite").parquet(f"{root}/{name}")
        return spark.read.schema(df.schema).parquet(f"{root}/{name}")

    # read once per dimension and once for the fact
    clean = cut(clean_admissions(flat))
    fact, dims = clean, {}
    for column, key, name in DIMENSIONS:
        dims[name] = store(build_dimension(clean, column, key), name)
        fact = attach_key(fact, column, dims[name], key)
    return Star(root, store(fact, "admissions"), dims["doctors"], dims["hospitals"], dims["insurance_providers"])


def by_dimension_name(fact: DataFrame, dim: DataFrame, key: str, fragment: str, limit: int = 200) -> DataFrame:
    """Fact rows whose dimension name contains `fragment` in any letter case, newest first."""
    named = dim.filter(F.contains(F.lower(F.col("name")), F.lit(fragment.lower())))
    return (
        fact.join(named, key)
        .select("admission_id", "patient_name", "condition", "admitted", "admission_type", F.col("name").alias("doctor"))
        .orderBy(F.desc("admitted"), "admission_id")
        .limit(limit)
    )


def merge_answers(data: DataFrame, policy: DataFrame) -> DataFrame:
    """One text per question from two answer tables `(question_id, success, answer, error)`.

    Both present: the successful parts with their labels, or a fixed text when neither
    succeeded. One present: its answer, else its error.
    """
    d, p = data.alias("d"), policy.alias("p")
    joined = d.join(p, F.col("d.question_id") == F.col("p.question_id"), "full_outer")
    d_ok, p_ok = F.coalesce("d.success", F.lit(False)), F.coalesce("p.success", F.lit(False))
    has_d, has_p = F.col("d.question_id").isNotNull(), F.col("p.question_id").isNotNull()
    both = F.concat_ws(
        "\n\n",
        F.when(d_ok, F.concat(F.lit("Data: "), F.col("d.answer"))),
        F.when(p_ok, F.concat(F.lit("Policy: "), F.col("p.answer"))),
    )
    text = (
        F.when(has_d & has_p & ~d_ok & ~p_ok, "Neither the database nor the policy documents could answer this.")
        .when(has_d & has_p, both)
        .when(has_d & d_ok, F.col("d.answer"))
        .when(has_d, F.coalesce("d.error", F.lit("I couldn't answer that from the database.")))
        .when(p_ok, F.col("p.answer"))
        .otherwise(F.coalesce("p.error", F.lit("I couldn't find that in the policy documents.")))
    )
    return joined.select(F.coalesce("d.question_id", "p.question_id").alias("question_id"), text.alias("final_answer"))
