"""A left join with a lookup table that stands up to hot keys.

AQE splits a skewed side only where both sides of the join come straight out
of a shuffle. Most lookups here are aggregates, so hot keys are split by hand.
"""

from pyspark.sql import functions as F

# Groups for each task, so that they spread evenly.
GROUPS = 4


def parts(rows):
    """Into how many parts Spark splits a shuffle at first: what one task is meant to hold is one of them."""
    conf = rows.sparkSession.conf
    return int(conf.get("spark.sql.adaptive.coalescePartitions.initialPartitionNum",
                        conf.get("spark.sql.shuffle.partitions")))


def hot_keys(rows, key, tasks):
    """(*key, groups) of the keys that hold more than one of `tasks` equal shares of the rows; None if there are none.

    They are counted now, with map-side aggregation, and come back as a small table of their own:
    fewer than `tasks` rows, whose groups are fewer than 2 * tasks. So the plans that use
    them, mostly more than once, do not hold the plan of the rows again each time.
    """
    total = rows.count()
    sizes = rows.groupBy(*key).agg(F.count("*").alias("n")).where(F.col("n") * tasks > total)
    hot = sizes.select(*key, F.ceil(F.col("n") * tasks / F.lit(total)).cast("int").alias("groups"))
    found = hot.collect()
    return F.broadcast(rows.sparkSession.createDataFrame(found, hot.schema)) if found else None


def with_groups(rows, hot, key):
    """Rows with ``groups``, the parts that their key is spread over: 1 where it is not hot."""
    if hot is None:
        return rows.withColumn("groups", F.lit(1))
    return rows.join(hot, key, "left").withColumn("groups", F.coalesce("groups", F.lit(1)))


def with_salt(rows, own, tasks, spread):
    """Rows with ``groups`` dealt by their column ``own`` to a salt; those marked by ``spread`` go to all tasks."""
    groups = F.when(spread, tasks).otherwise(F.col("groups"))
    return rows.withColumn("salt", F.pmod(F.xxhash64(own), groups).cast("int")).drop("groups")


def repeated(lookup):
    """Lookup rows with ``groups``, once for each salt."""
    return lookup.withColumn("salt", F.explode(F.sequence(F.lit(0), F.col("groups") - 1))).drop("groups")


def lookup_join(rows, lookup, key, own):
    """``rows`` with the columns of ``lookup``, which has one row per ``key``.

    A key is hot if it holds more rows than 1/GROUPS of a task's share, so there are
    fewer hot keys than GROUPS for each task, and they may always be broadcast. Its
    rows are spread by their column ``own`` over as many groups as it holds such
    parts, and the lookup's row is repeated for each. Rows without a key are spread over all. Keys are
    counted first, at once, so ``rows`` is read three times: pass a stored table.
    """
    tasks = GROUPS * parts(rows)
    hot = hot_keys(rows.where(F.col(key).isNotNull()).select(key), [key], tasks)
    left = with_salt(with_groups(rows, hot, [key]), own, tasks, F.col(key).isNull())
    return left.join(repeated(with_groups(lookup, hot, [key])), [key, "salt"], "left").drop("salt")
