"""The two questions the star exists for.

Both pre-aggregate the fact on the join key first (partial aggregation on
every task, so a key holding a third of the events shrinks before the
shuffle), then join the small aggregate to a small dimension aggregate.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from starmart.operators.joins import lookup_join

DEFAULT_WARM_THRESHOLD = 15.5


def arrivals_by_climate(fact: DataFrame, country_dim: DataFrame,
                        warm_threshold: float = DEFAULT_WARM_THRESHOLD) -> DataFrame:
    """Q3: ``(climate, arrivals, countries)``.

    ``climate`` is warm (average >= threshold), cold, or unknown (no average,
    unmapped or NULL code).  ``arrivals`` sums the ``count`` weight;
    ``countries`` counts distinct non-NULL residence codes.
    """
    per_code = (fact.groupBy("country_residence_code")
                .agg(F.sum("count").alias("arrivals")))
    temps = country_dim.select(F.col("country_code"), "average_temperature")
    # The dimension may be derived from the events: stage it so the size check
    # and the join do not both compute it.
    joined = lookup_join(per_code, temps,
                         per_code["country_residence_code"] == temps["country_code"], "left",
                         stage=True)
    t = F.col("average_temperature")
    band = (F.when(t.isNull(), "unknown").when(t >= F.lit(warm_threshold), "warm")
            .otherwise("cold"))
    return (joined.groupBy(band.alias("climate"))
            .agg(F.sum("arrivals").alias("arrivals"),
                 F.count_distinct("country_residence_code").alias("countries")))


def climate_of_events(events: DataFrame, mapping: DataFrame, temperatures: DataFrame,
                      warm_threshold: float = DEFAULT_WARM_THRESHOLD) -> DataFrame:
    """Q3 straight from cleaned events: one scan counts them per residence code,
    and that short table is both the fact and the list of countries."""
    from starmart.plans.dims import country_of
    per_code = (events.groupBy(F.col("i94res").alias("country_residence_code"))
                .agg(F.sum("count").alias("count"))).checkpoint(eager=True)
    codes = per_code.select(F.col("country_residence_code").alias("country_code"))
    return arrivals_by_climate(per_code, country_of(codes, mapping, temperatures), warm_threshold)


def state_population(demographics_dim: DataFrame) -> DataFrame:
    """``(state_code, population)`` with each city counted once.

    Rows are per (city, state, race) and repeat the city total per race, so
    city totals are taken once per (city, state) before summing per state:
    joining the raw rows to the fact would multiply arrivals.
    """
    cities = (demographics_dim.groupBy("state_code", "City", "State")
              .agg(F.max("total_population").alias("city_population")))
    return (cities.groupBy("state_code")
            .agg(F.sum("city_population").cast("bigint").alias("population")))


def arrivals_by_state(fact: DataFrame, demographics_dim: DataFrame,
                      monthly: bool = True) -> DataFrame:
    """Q4: arrivals per state and year (and month), next to the state population.

    Output: ``state_code, arrival_year[, arrival_month], population, arrivals,
    arrivals_per_100k``.
    """
    grain = [F.year("arrdate").alias("arrival_year")]
    if monthly:
        grain.append(F.month("arrdate").alias("arrival_month"))
    per_state = fact.groupBy(F.col("state_code"), *grain).agg(F.sum("count").alias("arrivals"))
    pop = state_population(demographics_dim)
    joined = lookup_join(per_state, pop, "state_code", "left", stage=True)
    names = ["state_code", "arrival_year"] + (["arrival_month"] if monthly else [])
    return joined.select(
        *names, "population", "arrivals",
        F.try_divide(F.col("arrivals") * 100000.0, F.col("population")).alias("arrivals_per_100k"))
