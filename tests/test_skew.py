"""One key, text or id holding a third of all rows: same results, no oversized work."""

from pyspark.sql import functions as F

from marginalia.operators import agreement, duplicates, reliability


def test_hot_id_on_both_sides_does_not_multiply_rows(spark):
    n = 30_000
    hot = F.when(F.col("id") % 3 == 0, F.lit("hot")).otherwise(F.col("id").cast("string"))
    label = F.when(F.col("id") % 2 == 0, "A").otherwise("B")
    side = spark.range(n).select(hot.alias("source_id"), label.alias("final_label"))
    counts = agreement.paired_counts(side, side, "source_id").collect()
    # 10,000 hot rows meet 10,000 hot rows: a hundred million pairs, counted but never built.
    assert sum(r["n"] for r in counts) == (n // 3) ** 2 + n - n // 3
    same = {(r["label_a"], r["label_b"]): r["n"] for r in counts}
    assert same["A", "B"] == same["B", "A"] == (n // 6) ** 2


def test_hot_text_shrinks_before_the_shuffle(spark):
    text = F.when(F.col("id") % 3 == 0, F.lit("the same text again")).otherwise(F.concat(F.lit("text "), "id"))
    df = spark.range(0, 30_000, 1, 8).select(
        text.alias("text"), F.when(F.col("id") % 2 == 0, "A").otherwise("B").alias("final_label")
    )
    got = duplicates.check_duplicates(df).first()
    assert got["exact_duplicates"] == 10_000 and got["label_conflicts_total"] == 1
    shown = duplicates.duplicate_label_conflicts(df).collect()
    assert [(r["text_key"], r["copies"], r["labels"]) for r in shown] == [("the same text again", 10_000, 2)]
    plan = duplicates.duplicate_groups(df)._jdf.queryExecution().executedPlan().toString()
    assert "partial_count" in plan and "SortAggregate" not in plan


def test_hot_item_in_alpha(spark):
    item = F.when(F.col("id") % 3 == 0, F.lit(0)).otherwise(F.col("id"))
    df = spark.range(9_000).select(item.alias("item"), (F.col("id") % 2).cast("string").alias("label"))
    got = reliability.krippendorff_alpha(df).first()
    assert got["n_items"] == 1 and got["n_values"] == 3_000 and abs(got["alpha"]) < 0.01
