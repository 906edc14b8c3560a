"""Column expressions for customer attributes."""

from pyspark.sql import Column
from pyspark.sql import functions as F

from starmill.functions.fixed import B2B_COUNTRIES, OTHER_REGION, REGIONS


def region_of(country: Column, regions: dict[str, str] = REGIONS) -> Column:
    lookup = F.create_map(*[F.lit(x) for pair in regions.items() for x in pair])
    return F.coalesce(F.try_element_at(lookup, country), F.lit(OTHER_REGION))


def segment_of(country: Column, b2b: list[str] = B2B_COUNTRIES) -> Column:
    return F.when(country.isin(*b2b), "B2B").otherwise("B2C")
