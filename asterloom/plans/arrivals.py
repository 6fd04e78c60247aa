"""The arrivals star: code lists, one fact, six dimensions, their analyses."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.casts import to_float
from ..functions.text import lon_lat, region_part, row_key
from ..functions.timeparts import from_sas_days, text_to_date
from ..operators.analysis import count_labels, count_values, top
from ..operators.joins import label_or_self
from ..operators.keys import identity_key
from ..operators.quality import orphan_counts, require_rows
from ..operators.rows import matching
from ..schemas import (
    ARRIVALS_RAW, ARRIVALS_STAR, COUNTRY_CODE, DIM_AIRLINE, DIM_AIRPORT, DIM_PERSONAL, DIM_POPULATION,
    DIM_STATISTICS, DIM_TEMPERATURE, FACT_IMMI, PORT_CODE, STATE_CODE, TRAVEL_CODE, VISA_CODE, TableSpec, schema_of,
)
from ..sinks.files import write_table
from ..sources.files import read_csv, read_parquet, read_tables
from ..sources.labels import parse_comment_list, parse_value_blocks, pick_list, read_scripts, reverse_list

HOME_COUNTRY = "United States"

# --- fixed values: source columns, their names here, and how they are read ---

FACT_FIELDS = (
    ("cicid", "cic_id", "int"),
    ("i94yr", "year", "int"),
    ("i94mon", "month", "int"),
    ("i94port", "port_code", "string"),
    ("i94addr", "state_code", "string"),
    ("arrdate", "arrive_date", "sas_days"),
    ("depdate", "departure_date", "sas_days"),
    ("i94mode", "travel_code", "int"),
    ("i94visa", "visa_code", "int"),
)
PERSONAL_FIELDS = (
    ("cicid", "cic_id", "int"),
    ("i94cit", "citizen_country", "int"),
    ("i94res", "residence_country", "int"),
    ("biryear", "birth_year", "int"),
    ("gender", "gender", "string"),
    ("insnum", "ins_num", "string"),
)
AIRLINE_FIELDS = (
    ("cicid", "cic_id", "int"),
    ("airline", "airline", "string"),
    ("admnum", "admin_num", "bigint"),
    ("fltno", "flight_number", "string"),
    ("visatype", "visa_type", "string"),
    ("i94port", "port_code", "string"),
)
POPULATION_FIELDS = (
    ("City", "city", "string"),
    ("State Code", "state_code", "string"),
    ("Male Population", "male_pop", "string"),
    ("Female Population", "female_pop", "string"),
    ("Number of Veterans", "num_vetarans", "string"),
    ("Foreign-born", "foreign_born", "string"),
    ("Race", "race", "string"),
)
STATISTICS_FIELDS = (
    ("City", "city", "string"),
    ("State Code", "state_code", "string"),
    ("Median Age", "median_age", "string"),
    ("Average Household Size", "avg_household_size", "string"),
)

DEMOGRAPHICS_RAW = schema_of(
    "City string, `State Code` string, `Male Population` string, `Female Population` string, "
    "`Number of Veterans` string, `Foreign-born` string, Race string, `Median Age` string, "
    "`Average Household Size` string"
)
AIRPORTS_RAW = schema_of(
    "iata_code string, name string, type string, iso_country string, iso_region string, "
    "municipality string, coordinates string"
)
TEMPERATURE_RAW = schema_of(
    "dt string, AverageTemperature string, AverageTemperatureUncertainty string, City string, Country string"
)

# Block of the format script -> table, label column, code type.
LABEL_BLOCKS: tuple[tuple[str, TableSpec, str, str], ...] = (
    ("i94cntyl", COUNTRY_CODE, "country", "int"),
    ("i94prtl", PORT_CODE, "port", "string"),
    ("i94addrl", STATE_CODE, "state", "string"),
    ("i94model", TRAVEL_CODE, "travel", "int"),
    ("i94visa", VISA_CODE, "visa", "int"),
)
VISA_COMMENT = "I94VISA"

# ------------------------------------------------------------------------------


def code_tables(scripts: DataFrame) -> dict[TableSpec, DataFrame]:
    """The five code lists of a format script."""
    parsed = parse_value_blocks(scripts).unionByName(parse_comment_list(scripts, VISA_COMMENT))
    return {spec: pick_list(parsed, block, label, dtype) for block, spec, label, dtype in LABEL_BLOCKS}


def port_codes_by_city(scripts: DataFrame) -> DataFrame:
    """(name, code): city name before the comma -> port code, later ones win."""
    ports = parse_value_blocks(scripts).filter(F.col("block") == "i94prtl")
    return reverse_list(ports, "label", "pos")


def _read_as(source: str, kind: str) -> Column:
    c = F.col(f"`{source}`")
    if kind == "sas_days":
        return from_sas_days(c)
    return c if kind == "string" else c.try_cast(kind)


def _keyed(raw: DataFrame, fields: Sequence[tuple[str, str, str]], key: str) -> DataFrame:
    """Distinct raw rows, typed and renamed, with a key over the raw row.

    The rows are distinct, so the keys are; and they are the same next time.
    """
    sources = [source for source, _, _ in fields]
    rows = raw.select(*[F.col(f"`{s}`") for s in sources]).distinct()
    return rows.select(
        *[_read_as(source, kind).alias(name) for source, name, kind in fields], row_key(sources).alias(key)
    )


def fact_immi(arrivals: DataFrame) -> DataFrame:
    return _keyed(arrivals, FACT_FIELDS, "immigration_id").withColumn("country", F.lit(HOME_COUNTRY))


def dim_personal(arrivals: DataFrame) -> DataFrame:
    return _keyed(arrivals, PERSONAL_FIELDS, "immi_person_id")


def dim_airline(arrivals: DataFrame) -> DataFrame:
    return _keyed(arrivals, AIRLINE_FIELDS, "immi_airline_id")


def dim_population(demographics: DataFrame, upper_city: bool = False) -> DataFrame:
    rows = _keyed(demographics, POPULATION_FIELDS, "pop_id")
    return rows.withColumn("city", F.upper("city")) if upper_city else rows


def dim_statistics(demographics: DataFrame) -> DataFrame:
    return _keyed(demographics, STATISTICS_FIELDS, "stat_id").withColumn("city", F.upper("city"))


def with_city_code(rows: DataFrame, ports_by_city: DataFrame, into: str = "city_code") -> DataFrame:
    """The port code of a city, or the city itself where it has none."""
    return label_or_self(rows, "city", ports_by_city, "name", "code", into)


def dim_airport(airports: DataFrame, country: str = "US") -> DataFrame:
    """Airports of one country that have a code; coordinates split in two."""
    lon, lat = lon_lat("coordinates")
    kept = matching(airports.filter(F.col("iata_code").isNotNull()), iso_country=country)
    return kept.select([f.name for f in AIRPORTS_RAW.fields]).distinct().select(
        "iata_code", "name", "type", F.lit(HOME_COUNTRY).alias("country"), "municipality",
        lon.alias("longitude"), lat.alias("latitude"), region_part("iso_region").alias("state_code"),
    )


def dim_temperature(temperatures: DataFrame, country: str = HOME_COUNTRY) -> DataFrame:
    """Readings of one country with year, month and a dense row number.

    Readings may repeat exactly, so no key over the row would be unique.
    """
    rows = matching(temperatures, Country=country).select(
        text_to_date("dt").alias("dt"),
        to_float("AverageTemperature").alias("avg_temp"),
        to_float("AverageTemperatureUncertainty").alias("avg_temp_uncertnty"),
        F.col("City").alias("city"),
        F.col("Country").alias("country"),
    )
    dated = rows.withColumns({"year": F.year("dt"), "month": F.month("dt")})
    return identity_key(dated, "record_id", ["dt", "city", "avg_temp", "avg_temp_uncertnty"])


def build_star(
    scripts: DataFrame, arrivals: DataFrame, demographics: DataFrame, airports: DataFrame, temperatures: DataFrame
) -> dict[TableSpec, DataFrame]:
    return {
        **code_tables(scripts),
        DIM_PERSONAL: dim_personal(arrivals),
        DIM_AIRLINE: dim_airline(arrivals),
        DIM_POPULATION: dim_population(demographics),
        DIM_STATISTICS: dim_statistics(demographics),
        DIM_AIRPORT: dim_airport(airports),
        DIM_TEMPERATURE: dim_temperature(temperatures),
        FACT_IMMI: fact_immi(arrivals),
    }


def load_star(
    spark: SparkSession,
    labels: str,
    arrivals: str,
    demographics: str,
    airports: str,
    temperatures: str,
    root: str,
) -> dict[str, DataFrame]:
    """Read the five inputs, write the twelve tables, check that all have rows.

    Arrivals are Parquet, read by column for each of the three tables on them.
    """
    star = build_star(
        read_scripts(spark, labels),
        read_parquet(spark, arrivals, ARRIVALS_RAW),
        read_csv(spark, demographics, DEMOGRAPHICS_RAW, sep=";"),
        read_csv(spark, airports, AIRPORTS_RAW),
        read_csv(spark, temperatures, TEMPERATURE_RAW),
    )
    for spec, rows in star.items():
        write_table(rows, spec, root)
    stored = read_tables(spark, ARRIVALS_STAR, root)
    for name, table in stored.items():
        require_rows(table, name)
    return stored


def integrity(star: Mapping[str, DataFrame]) -> DataFrame:
    """(check, n): fact keys each dimension lacks."""
    fact = star["fact_immi"]
    return orphan_counts({
        "airline": (fact, "cic_id", star["dim_immi_airline"], "cic_id"),
        "airports": (fact, "port_code", star["dim_airport"], "iata_code"),
        "population": (fact, "state_code", star["dim_demographic_population"], "state_code"),
        "statistics": (fact, "state_code", star["dim_demographic_statistics"], "state_code"),
        "personal": (fact, "cic_id", star["dim_immi_personal"], "cic_id"),
    })


def top_citizen_countries(personal: DataFrame, countries: DataFrame, n: int = 5) -> DataFrame:
    counted = count_labels(personal, "citizen_country", countries, "code", "country")
    return top(counted, n, "n", ["country"])


def top_states(fact: DataFrame, states: DataFrame, n: int = 5) -> DataFrame:
    return top(count_labels(fact, "state_code", states, "code", "state"), n, "n", ["state"])


def top_birth_years(personal: DataFrame, n: int = 5) -> DataFrame:
    return top(count_values(personal, "birth_year"), n, "n", ["birth_year"])


def gender_by_country(personal: DataFrame, countries: DataFrame, names: Sequence[str]) -> DataFrame:
    """Counts per country and gender for the named countries, most first.

    A missing gender counts 0, as a count of it does.
    """
    wanted = matching(countries, country=list(names))
    counted = count_labels(personal, "citizen_country", wanted, "code", "country", by=["gender"], how="inner")
    counted = counted.withColumn("n", F.when(F.col("gender").isNull(), 0).otherwise(F.col("n")).cast("bigint"))
    return counted.orderBy(F.desc("n"), "country", "gender")
