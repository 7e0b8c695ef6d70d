"""A whole load: source frames to marts and reports.

Every stage is published as a table before the next one reads it, so a later
stage reads only the columns it needs, sizes are known, and a lost executor
costs the running stage at most.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Iterator, Mapping
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from starloom import constants as K
from starloom import schemas as S
from starloom.operators import action_counts, upsert
from starloom.operators.merge import merge_into, roomy
from starloom.operators.upsert import ACTION
from starloom.plans import clean, dims, facts, marts, validation
from starloom.session import known_size, run_folder, sized_for, stage_table
from starloom.sources import SnapshotTable, with_audit

DIMENSIONS = [
    "DimDate", "DimDistrict", "DimAccount", "DimClient", "DimLoanStatus", "DimTransactionType",
    "DimOperation",
]
#: the business key and the surrogate key of each dimension that loads update
DIMENSION_KEYS = {
    "DimDistrict": ("DistrictID", "DistrictKey"), "DimAccount": ("AccountID", "AccountKey"),
    "DimClient": ("ClientID", "ClientKey"), "DimLoanStatus": ("LoanStatusCode", "LoanStatusKey"),
    "DimTransactionType": ("TransactionTypeCode", "TransactionTypeKey"),
    "DimOperation": ("OperationCode", "OperationKey"),
}
#: months of an increment beyond which the monthly mart is built anew
MOST_MONTHS = 600
CLEAN = ["account_clean", "district_clean", "client_clean", "loan_clean", "transaction_clean"]


class Warehouse:
    """``calendar`` cuts facts off outside of its range; without one, it holds every staged date.

    After a run, versions older than ``retention`` go from all tables, but never the
    last two; ``None`` keeps everything.  No reader and no load may take longer.
    """

    def __init__(
        self,
        spark: SparkSession,
        root: str,
        source_system: str,
        calendar: tuple[dt.date, dt.date] | None = None,
        observed_to: dt.date = K.OBSERVATION_END,
        on_missing: str = "unknown",
        retention: dt.timedelta | None = dt.timedelta(days=7),
    ) -> None:
        self.spark = spark
        self.root = root.rstrip("/")
        self.source_system = source_system
        self.calendar = calendar
        self.observed_to = observed_to
        self.on_missing = on_missing
        self.retention = retention
        self._tables: dict[str, SnapshotTable] = {}
        #: versions of the transaction fact before and after the last append, and its months
        self._appended: tuple[int, int, list[int]] | None = None
        #: updated / inserted / kept rows of the last load, per table
        self.actions: dict[str, DataFrame] = {}
        #: unmatched rows of the last load, per fact
        self.unmatched: dict[str, DataFrame] = {}

    # --- tables ---

    def table(self, layer: str, name: str) -> SnapshotTable:
        path = f"{self.root}/{layer}/{name}"
        if path not in self._tables:
            if name == "FactTransaction":
                made = facts.transaction_table(self.spark, path)
            elif name == "FactLoan":
                made = facts.loan_table(self.spark, path)
            elif name in DIMENSION_KEYS:
                business, surrogate = DIMENSION_KEYS[name]
                made = SnapshotTable(self.spark, path, key=surrogate, bucket_by=business)
            else:
                made = SnapshotTable(self.spark, path)
            self._tables[path] = made
        return self._tables[path]

    def read(self, layer: str, name: str) -> DataFrame:
        return self.table(layer, name).read()

    def dimensions(self) -> dict[str, DataFrame]:
        return {name: self.read("dim", name) for name in DIMENSIONS}

    def _load_dim(self, name: str, source: DataFrame, update, protect=None, scope=None) -> None:
        """Upsert a dimension; once published, only its changed buckets are written."""
        table, (business, surrogate) = self.table("dim", name), DIMENSION_KEYS[name]
        # read by several steps
        source = source if known_size(source) else stage_table(source, name)
        if roomy(table, known_size(source)[0]):
            did = merge_into(table, source, business, update, surrogate, protect, scope)
        else:
            since = table.version()
            target = table.read() if since else dims.new_dimensions(self.spark)[name]
            result = stage_table(upsert(target, source, business, update, surrogate, protect, scope), name)
            did = action_counts(result)
            table.publish(result.drop(ACTION), known_size(result)[0], since)
        self.actions[name] = self._keep(did)

    def _keep(self, report: DataFrame) -> DataFrame:
        """A report of a few rows, free of the stage tables it was made from."""
        return self.spark.createDataFrame(report.collect(), report.schema)

    # --- stages ---

    def stage(self, sources: Mapping[str, DataFrame], run_ts: dt.datetime) -> None:
        for name, source in sources.items():
            self.table("stg", name).publish(with_audit(source, run_ts), source.count())

    def clean(self) -> None:
        def stg(name: str) -> DataFrame:
            return self.read("stg", name)

        def publish(name: str, df: DataFrame) -> DataFrame:
            return self.table("clean", name).publish(df)

        accounts = publish(
            "account_clean",
            clean.account_clean(stg("account"), self.source_system, self.observed_to),
        )
        districts = publish("district_clean", clean.district_clean(stg("district")))
        publish(
            "client_clean",
            clean.client_clean(stg("client"), stg("disp"), districts, self.observed_to),
        )
        publish("loan_clean", clean.loan_clean(stg("loan"), accounts))
        publish("transaction_clean", clean.transaction_clean(stg("trans"), accounts))

    def load_dimensions(self) -> None:
        spark = self.spark
        days = self.calendar or dims.calendar_range(
            [(self.read("stg", "loan"), "date"), (self.read("stg", "trans"), "date")]
        )
        self.table("dim", "DimDate").publish(dims.dim_date(spark, *days), dims.calendar_days(*days))
        self._load_dim(
            "DimDistrict", self.read("clean", "district_clean"), dims.DISTRICT_ATTRIBUTES,
            dims.unknown_member("DistrictID"),
        )
        current = F.col("IsCurrent")
        self._load_dim(
            "DimAccount", dims.account_source(self.read("clean", "account_clean")), dims.ACCOUNT_ATTRIBUTES,
            dims.unknown_member("AccountID"), current,
        )
        self._load_dim(
            "DimClient",
            dims.client_source(self.read("clean", "client_clean"), self.read("dim", "DimDistrict")),
            dims.CLIENT_ATTRIBUTES, scope=current,
        )
        for name, values in (
            ("DimLoanStatus", dims.loan_status_values(spark)),
            ("DimTransactionType", dims.transaction_type_values(spark)),
            ("DimOperation", dims.operation_values(spark)),
        ):
            self._load_dim(name, values, [c for c in values.columns if c != DIMENSION_KEYS[name][0]])

    def load_facts(self) -> None:
        found = self.dimensions()
        facts.require_unknown_members(found, [*facts.LOAN_DIMS, *facts.TRANSACTION_DIMS])

        loans = facts.resolve_loans(self.read("clean", "loan_clean"), found, self.on_missing)
        self.unmatched["FactLoan"] = self._keep(loans.unmatched)
        self.actions["FactLoan"] = self._keep(facts.merge_loans(self.table("fact", "FactLoan"), loans))

        table = self.table("fact", "FactTransaction")
        since = table.version()
        load = facts.append_transactions(table, self.read("clean", "transaction_clean"), found, self.on_missing)
        self.unmatched["FactTransaction"] = self._keep(load.unmatched)
        rows = facts.with_year(load.rows)
        # no more months than the calendar has
        months = [r[0] for r in rows.select(F.floor(F.col("DateKey") / 100).cast("int")).distinct().collect()]
        # numbered by ranges of ids
        table.append(rows, since, spread=False)
        self._appended = (since, table.version(), months)

    def build_marts(self) -> None:
        """Both marts; of the monthly one only the months that the last append touched, if it was built just before."""
        table, fact = self.table("mart", "MonthlyTransactionPerformance"), self.table("fact", "FactTransaction")
        calendar, built = self.read("dim", "DimDate"), table.note().get("fact")
        version = fact.version()
        before, after, months = self._appended or (None, None, [])
        if built != version:
            if built is not None and (built, version) == (before, after) and len(months) <= MOST_MONTHS:
                result = marts.refresh_monthly(table.read(), fact.read(), calendar, months)
            else:
                result = marts.monthly_transactions(fact.read(), calendar)
            table.publish(result, note={"fact": version})
        self.table("mart", "DistrictLoanPerformance").publish(
            marts.district_loans(self.read("fact", "FactLoan"), self.read("dim", "DimDistrict"))
        )

    def validate(self) -> dict[str, DataFrame]:
        """The reports of a finished load, each a few rows."""
        found = self.dimensions()
        loans, transactions = self.read("fact", "FactLoan"), self.read("fact", "FactTransaction")
        monthly = self.read("mart", "MonthlyTransactionPerformance")
        districts = self.read("mart", "DistrictLoanPerformance")
        # the log has counted them
        counted = {n: self.table("stg", n).rows() for n in ("account", "client", "district", "loan", "trans")}
        counted |= {n: self.table("clean", n).rows() for n in CLEAN}
        counted |= {n: self.table("fact", n).rows() for n in ("FactLoan", "FactTransaction")}
        reports = {
            "row_counts": validation.stage_row_counts(counted),
            "integrity": validation.integrity_report(loans, transactions, found),
            "reconciliation": validation.reconciliation(loans, transactions, monthly, districts),
            "excluded_loans": marts.excluded_loans(loans, found["DimDistrict"]),
            "rules": validation.fact_loan_rules(loans, found)
            .unionByName(validation.fact_transaction_rules(transactions, found))
            .unionByName(validation.dim_date_rules(found["DimDate"]))
            .unionByName(validation.dim_account_rules(found["DimAccount"]))
            .unionByName(validation.dim_client_rules(found["DimClient"], found["DimDistrict"]))
            .unionByName(validation.dim_district_rules(found["DimDistrict"]))
            .unionByName(validation.dim_loan_status_rules(found["DimLoanStatus"]))
            .unionByName(validation.dim_transaction_type_rules(found["DimTransactionType"]))
            .unionByName(validation.dim_operation_rules(found["DimOperation"]))
            .unionByName(validation.mart_rules(monthly, districts)),
        }
        return {name: self._keep(report) for name, report in reports.items()}

    def run(self, sources: Mapping[str, DataFrame], run_ts: dt.datetime) -> dict[str, DataFrame]:
        """All stages in order; running it again with the same sources adds nothing.

        Scratch tables go when the load is published.
        """
        self.stage(sources, run_ts)
        with run_folder(self.spark), self._sized(sources):
            self.clean()
            self.load_dimensions()
            self.load_facts()
            self.build_marts()
            reports = self.validate()
        self.expire()
        return reports

    def expire(self) -> None:
        """Remove what is older than the retention from the tables of this load."""
        if self.retention is not None:
            for table in self._tables.values():
                table.expire(older_than=self.retention)

    @contextmanager
    def _sized(self, sources: Mapping[str, DataFrame]) -> Iterator[None]:
        """As many shuffle partitions as the staged rows need, never fewer than the session has."""
        name = "spark.sql.shuffle.partitions"
        staged = sum(self.table("stg", n).rows() * 16 * len(df.columns) for n, df in sources.items())
        before = self.spark.conf.get(name)
        self.spark.conf.set(name, max(int(before), int(sized_for(staged)[name])))
        try:
            yield
        finally:
            self.spark.conf.set(name, before)
