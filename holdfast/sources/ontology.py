"""Classes of products and what each is a kind of."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

# Class, broader class; a class may have several
SUBCLASSES = [
    ("FinancialProduct", None), ("Product", "FinancialProduct"), ("FinancialInstrument", None), ("Security", "FinancialInstrument"), ("EquitySecurity", "Product"),
    ("DebtInstrument", "Security"), ("Bond", "DebtInstrument"), ("KoreanBond", "Bond"), ("KoreanBond", "Product"),
    ("CollectiveInvestment", "FinancialInstrument"), ("Fund", "CollectiveInvestment"), ("PublicFund", "Fund"), ("PublicFund", "Product"), ("MutualFund", "Fund"),
    ("ETF", "Fund"), ("KoreanETF", "ETF"), ("KoreanETF", "Product"), ("GlobalETF", "ETF"), ("GlobalETF", "Product"),
    ("ETN", "DebtInstrument"), ("ETN", "Product"), ("ETN", "ListedSecurity"), ("KoreanETN", "ETN"), ("GlobalETN", "ETN"),
    ("FundUnit", "Security"), ("PublicFundUnit", "FundUnit"), ("TradableFundUnit", "FundUnit"), ("NonTradableFundUnit", "FundUnit"), ("ListedSecurity", "Security"), ("Listing", None),
    ("SourceDataset", None), ("SourceFile", None), ("SourceRecord", None), ("FieldDefinition", None), ("DataQualityIssue", None),
    ("Organization", None), ("Company", "Organization"), ("Market", None), ("Benchmark", None), ("Classification", None), ("Offering", None),
    ("Observation", None), ("BondSnapshot", "Observation"), ("MarketSnapshot", "Observation"), ("FundSnapshot", "Observation"), ("PortfolioSnapshot", "Observation"),
    ("HoldingPosition", "Observation"), ("BenchmarkConstituentSnapshot", "Observation"), ("CorporateRelationshipAssertion", "Observation"), ("RiskFactor", "Observation"),
    ("DisclosureDocument", "SourceFile"), ("DocumentSection", "SourceRecord"), ("EvidencePassage", "SourceRecord"),
]


def classes(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame([(c,) for c in dict(SUBCLASSES)], "class string")


def subclass_of(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame([(c, p) for c, p in SUBCLASSES if p], "child string, parent string")
