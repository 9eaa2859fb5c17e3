"""Register rows to an enriched company table with reports."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from kontor import fixed_values as V
from kontor.functions.dates import registration_date
from kontor.operators import reports
from kontor.operators.filters import with_any
from kontor.operators.joins import merge_classes, merge_contacts
from kontor.operators.projection import normalise_names, vertical_split
from kontor.operators.sizing import written
from kontor.sources.store import write_table

CONTACTS_VIEW = "v_companies_with_contacts"
STATS_VIEW = "v_category_stats"


def reachable(register: DataFrame, contacts: DataFrame, key: str = "IDI") -> DataFrame:
    """Register rows joined with contacts, kept if any contact is known.

    The filter makes the left join an inner join in the optimiser.
    """
    return with_any(merge_contacts(register, contacts, key))


def enriched(register: DataFrame, contacts: DataFrame, classified: DataFrame, key: str = "IDI") -> DataFrame:
    """Register, contacts and classes in one row per company with a contact."""
    return merge_classes(reachable(register, contacts, key), classified, key)


@dataclass(frozen=True)
class Directory:
    """The flat model: company columns and the rest, both with the id; rows of each table as counted while they were written."""

    companies: DataFrame
    metadata: DataFrame
    counts: dict[str, int] | None = None

    def with_contacts(self) -> DataFrame:
        return with_any(self.companies, ["phone_numbers", "email", "website"])

    def category_stats(self) -> DataFrame:
        return reports.contact_coverage(self.companies, "category")

    def register_views(self) -> None:
        """Create or replace the two views."""
        self.with_contacts().createOrReplaceTempView(CONTACTS_VIEW)
        self.category_stats().createOrReplaceTempView(STATS_VIEW)

    def write(self, path: str) -> dict[str, int]:
        """Companies split by category and sorted by id, metadata sorted by id; gives the rows of both."""
        return {
            "companies": write_table(self.companies, f"{path}/companies", partition_by=["category"], sort_by=["idi"]),
            "company_metadata": write_table(self.metadata, f"{path}/company_metadata", sort_by=["idi"]),
        }


def flat_model(classified: DataFrame, key: str = "IDI") -> Directory:
    """Typed dates, main and metadata columns apart, names normalised."""
    dated = classified.withColumn("Registration_date", registration_date("Registration_date"))
    main, rest = vertical_split(dated, V.MAIN_COLUMNS, key)
    return Directory(normalise_names(main), normalise_names(rest))


def build(register: DataFrame, contacts: DataFrame, classified: DataFrame, path: str, key: str = "IDI") -> Directory:
    """The whole chain: join, filter, label, type, split, store.  Returns the stored tables, views registered.

    The joined rows feed both tables, so they are written once before they are split.
    """
    model = flat_model(written(enriched(register, contacts, classified, key), "enriched"), key)
    counts = model.write(path)
    read = register.sparkSession.read
    stored = Directory(
        read.schema(model.companies.schema).parquet(f"{path}/companies"),
        read.schema(model.metadata.schema).parquet(f"{path}/company_metadata"),
        counts,
    )
    stored.register_views()
    return stored


def load_report(directory: Directory) -> DataFrame:
    """Rows of both tables: as counted by the write, or from the tables if somebody else has written them."""
    if directory.counts is not None:
        return directory.companies.sparkSession.createDataFrame(list(directory.counts.items()), "table string, n bigint")

    def size(name: str, df: DataFrame) -> DataFrame:
        return df.agg(F.count("*").alias("n")).select(F.lit(name).alias("table"), "n")

    return size("companies", directory.companies).unionByName(size("company_metadata", directory.metadata))
