"""The tables of a load, built on demand from the roles and written per stage."""

from __future__ import annotations

from functools import cached_property

from pyspark.sql import DataFrame, SparkSession

from catalogue.roles import OBSERVED_TO, SOURCE_SYSTEM, staged, table
from starloom.operators.upsert import ACTION
from starloom.plans import clean, dims, facts, marts
from starloom.session import local_rows, stage_table


class Bank:
    def __init__(self, spark: SparkSession, sf_dir: str) -> None:
        self.spark = spark
        self.sf_dir = sf_dir

    def table(self, name: str) -> DataFrame:
        return table(self.spark, self.sf_dir, name)

    def stg(self, name: str) -> DataFrame:
        return staged(self.spark, self.sf_dir, name)

    # --- clean tables ---

    @cached_property
    def account_clean(self) -> DataFrame:
        return stage_table(clean.account_clean(self.stg("account"), SOURCE_SYSTEM, OBSERVED_TO))

    @cached_property
    def district_clean(self) -> DataFrame:
        return stage_table(clean.district_clean(self.stg("district")))

    @cached_property
    def client_clean(self) -> DataFrame:
        return stage_table(
            clean.client_clean(
                self.stg("client"), self.stg("disp"), self.district_clean, OBSERVED_TO
            )
        )

    @cached_property
    def loan_clean(self) -> DataFrame:
        return stage_table(clean.loan_clean(self.stg("loan"), self.account_clean))

    @cached_property
    def transaction_clean(self) -> DataFrame:
        return stage_table(clean.transaction_clean(self.stg("trans"), self.account_clean))

    # --- dimensions ---

    @cached_property
    def _new(self):
        return dims.new_dimensions(self.spark)

    @cached_property
    def dim_date(self) -> DataFrame:
        """The calendar of the years in which there are loans or transactions."""
        days = dims.calendar_range([(self.stg("loan"), "date"), (self.stg("trans"), "date")])
        return dims.stored_calendar(self.spark, *days)

    @cached_property
    def dim_district(self) -> DataFrame:
        return stage_table(
            dims.load_district(self._new["DimDistrict"], self.district_clean).drop(ACTION)
        )

    @cached_property
    def dim_account(self) -> DataFrame:
        return stage_table(
            dims.load_account(self._new["DimAccount"], self.account_clean).drop(ACTION)
        )

    @cached_property
    def dim_client(self) -> DataFrame:
        return stage_table(
            dims.load_client(self._new["DimClient"], self.client_clean, self.dim_district).drop(ACTION)
        )

    def _lookup(self, name: str, values: DataFrame, code: str, key: str) -> DataFrame:
        return stage_table(dims.load_lookup(self._new[name], values, code, key).drop(ACTION))

    @cached_property
    def dim_loan_status(self) -> DataFrame:
        return self._lookup(
            "DimLoanStatus", dims.loan_status_values(self.spark), "LoanStatusCode", "LoanStatusKey"
        )

    @cached_property
    def dim_transaction_type(self) -> DataFrame:
        return self._lookup(
            "DimTransactionType", dims.transaction_type_values(self.spark),
            "TransactionTypeCode", "TransactionTypeKey",
        )

    @cached_property
    def dim_operation(self) -> DataFrame:
        return self._lookup(
            "DimOperation", dims.operation_values(self.spark), "OperationCode", "OperationKey"
        )

    @cached_property
    def loan_dims(self) -> dict[str, DataFrame]:
        return {
            "DimDate": self.dim_date,
            "DimDistrict": self.dim_district,
            "DimAccount": self.dim_account,
            "DimLoanStatus": self.dim_loan_status,
        }

    @cached_property
    def transaction_dims(self) -> dict[str, DataFrame]:
        return {
            "DimDate": self.dim_date,
            "DimDistrict": self.dim_district,
            "DimAccount": self.dim_account,
            "DimTransactionType": self.dim_transaction_type,
            "DimOperation": self.dim_operation,
        }

    @property
    def dims(self) -> dict[str, DataFrame]:
        return {**self.loan_dims, **self.transaction_dims}

    # --- facts and marts ---

    @cached_property
    def no_loans(self) -> DataFrame:
        return local_rows(self.spark, [], facts.S.FACT_LOAN)

    @cached_property
    def no_transactions(self) -> DataFrame:
        return local_rows(self.spark, [], facts.S.FACT_TRANSACTION)

    @cached_property
    def fact_loan(self) -> DataFrame:
        load = facts.resolve_loans(self.loan_clean, self.loan_dims, "unknown")
        # into an empty table: numbered by position in a table that is written already
        return facts.upsert_loans(self.no_loans, load).drop(ACTION)

    @cached_property
    def fact_transaction(self) -> DataFrame:
        # numbered by position in a table that is written already
        return facts.append_transactions(
            self.no_transactions, self.transaction_clean, self.transaction_dims, "unknown"
        ).rows

    @cached_property
    def monthly(self) -> DataFrame:
        return stage_table(marts.monthly_transactions(self.fact_transaction, self.dim_date))

    @cached_property
    def district_mart(self) -> DataFrame:
        return stage_table(marts.district_loans(self.fact_loan, self.dim_district))
