"""US-EPA air-quality index as plain column expressions."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

from hazeframe.functions.numeric import as_column

# The public EPA tables (pre-2024 for PM2.5). The first band starts at 0;
# every later band starts one concentration step above the previous upper edge.
INDEX_BANDS = ((0, 50), (51, 100), (101, 150), (151, 200), (201, 300), (301, 400), (401, 500))
UPPER_EDGES = {
    "pm25": (12.0, 35.4, 55.4, 150.4, 250.4, 350.4, 500.4),
    "pm10": (54.0, 154.0, 254.0, 354.0, 424.0, 504.0, 604.0),
    "no2": (53.0, 100.0, 360.0, 649.0, 1249.0, 1649.0, 2049.0),
}
DECIMALS = {"pm25": 1, "pm10": 0, "no2": 0}
TOP_INDEX = 500
CATEGORY_BANDS = (
    ("Good", 0, 50),
    ("Moderate", 51, 100),
    ("Unhealthy for Sensitive Groups", 101, 150),
    ("Unhealthy", 151, 200),
    ("Very Unhealthy", 201, 300),
    ("Hazardous", 301, 500),
)
CATEGORIES = tuple(label for label, _, _ in CATEGORY_BANDS)
UNHEALTHY = CATEGORIES[2:]
COLORS = {
    "Good": "#00e400",
    "Moderate": "#ffff00",
    "Unhealthy for Sensitive Groups": "#ff7e00",
    "Unhealthy": "#ff0000",
    "Very Unhealthy": "#8f3f97",
    "Hazardous": "#7e0023",
}
NO_DATA_COLOR = "#999999"


def truncate(value: Column | str, decimals: int) -> Column:
    """Cut (not round) to a number of decimals."""
    scale = float(10**decimals)
    return F.floor(as_column(value) * F.lit(scale)).cast("double") / F.lit(scale)


def cut(value: Column | str, pollutant: str) -> Column:
    """Concentration as the index tables take it: truncated to the decimals of the pollutant."""
    return truncate(value, DECIMALS[pollutant])


def index_of_cut(conc: Column | str, pollutant: str) -> Column:
    """Index of a truncated concentration: NULL when missing or negative, 500 above the top band."""
    conc = as_column(conc)
    decimals, edges = DECIMALS[pollutant], UPPER_EDGES[pollutant]
    step = 10.0**-decimals
    lower_edges = (0.0, *(round(edge + step, decimals) for edge in edges[:-1]))
    # Truncated values leave no gap between bands, so the upper edges alone tell them apart.
    index = F.when(conc < 0, F.lit(None).cast("double"))
    for (i_low, i_high), c_low, c_high in zip(INDEX_BANDS, lower_edges, edges):
        slope = (i_high - i_low) / (c_high - c_low)
        line = F.lit(slope) * (conc - F.lit(c_low)) + F.lit(float(i_low))
        index = index.when(conc <= c_high, F.rint(line))
    return index.when(conc > edges[-1], F.lit(float(TOP_INDEX)))


def concentration_to_aqi(value: Column | str, pollutant: str) -> Column:
    """Index of one concentration. For large inputs, select `cut` first and apply `index_of_cut` to that
    column: the ladder refers to its input many times."""
    return index_of_cut(cut(value, pollutant), pollutant)


def aqi_category(aqi: Column | str) -> Column:
    """Band of a whole-numbered index, NULL outside every band."""
    aqi = as_column(aqi)
    return F.coalesce(*[F.when(aqi.between(low, high), F.lit(name)) for name, low, high in CATEGORY_BANDS])


def marker_color(avg_aqi: Column | str) -> Column:
    """Colour of an average index. Upper bounds only, so fractions between bands get a colour too."""
    avg_aqi = as_column(avg_aqi)
    color = F.when(avg_aqi.isNull(), F.lit(NO_DATA_COLOR))
    for name, _, high in CATEGORY_BANDS[:-1]:
        color = color.when(avg_aqi <= high, F.lit(COLORS[name]))
    return color.otherwise(F.lit(COLORS[CATEGORIES[-1]]))


def overall(indexes: dict[str, Column]) -> Column:
    """Largest index of a reading, missing ones skipped."""
    return F.greatest(*indexes.values())


def dominant(indexes: dict[str, Column]) -> Column:
    """Pollutant with the largest index; the first one listed wins ties."""
    top = overall(indexes)
    return reduce(
        lambda chosen, item: F.coalesce(chosen, F.when(item[1] == top, F.lit(item[0]))),
        indexes.items(),
        F.lit(None).cast("string"),
    )
