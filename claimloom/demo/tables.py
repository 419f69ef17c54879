"""Claims and a code table derived from orders, lineitem and part.

The items of an order, in order of their number, fill the procedure slots of its claim
lines, ten to a line; an order has as many lines as its items need, at least one. The code
table has one entry for every part of the types used, so it grows with the parts.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from claimloom.functions import fixed_values as fixed
from claimloom.sources import CLAIMS, CODES, read_parquet, split_codes
from claimloom.sources.schemas import SLOT_COUNT

LINES_PER_ORDER = 1 << 20
CODE_WIDTH = 10

ICD_PART_TYPES = ("ECONOMY", "MEDIUM", "SMALL")
HCPCS_PART_TYPES = ("LARGE", "PROMO", "STANDARD")
DRG_PART_TYPES = ("PROMO", "SMALL")


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One of the driver's tables."""
    return read_parquet(spark, f"{sf_dir}/{name}.parquet")


def _padded(number: Column, width: int) -> Column:
    return F.lpad(number.cast("string"), width, "0")


def _one_of(values: tuple[str, ...], number: Column) -> Column:
    """The value at a place that goes round and round."""
    place = (number % len(values)).cast("int")
    return F.element_at(F.array(*[F.lit(v) for v in values]), place + 1)


def _lines(lineitem: DataFrame) -> DataFrame:
    """Claim lines of each order with the part in each slot; equal items stay apart."""
    in_order = Window.partitionBy("l_orderkey").orderBy("l_linenumber", "l_partkey", "l_suppkey")
    place = F.row_number().over(in_order) - 1
    items = lineitem.select("l_orderkey", "l_partkey", place.alias("place"))
    line = F.floor(F.col("place") / SLOT_COUNT).alias("line")
    return items.groupBy("l_orderkey", line).agg(
        *[
            F.max(F.when(F.col("place") % SLOT_COUNT == n, F.col("l_partkey"))).alias(
                f"part{n + 1}"
            )
            for n in range(SLOT_COUNT)
        ]
    )


def claims(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The claim lines, with nulls in every column that may be null."""
    key = F.col("o_orderkey")
    line = F.coalesce(F.col("line"), F.lit(0).cast("long"))

    def null_every(n: int, value: Column) -> Column:
        return F.when(key % n != 0, value)

    ordered = F.col("o_orderdate").cast("date")
    start = null_every(227, ordered)
    status, priority = F.col("o_orderstatus"), F.col("o_orderpriority")
    urgent = priority == "1-URGENT"
    customer = F.col("o_custkey").cast("string")

    def days_after(n: int) -> Column:
        return F.date_add(start, (key % n).cast("int"))

    def by_parity(even: str, odd: str) -> Column:
        return F.when(key % 2 == 0, F.lit(even)).otherwise(F.lit(odd))

    columns = {
        "sequencenumber": key * LINES_PER_ORDER + line,
        "member_id": null_every(223, F.concat(F.lit("M"), customer)),
        "caseadmitid": null_every(
            211, F.concat(F.lit("A"), customer, F.lit("_"), F.year(ordered).cast("string"))
        ),
        "claimid": F.concat(F.lit("C"), key.cast("string")),
        "line_number": (line + 1).cast("string"),
        "prm_fromdate": start,
        "prm_todate": days_after(5),
        "prm_drg": null_every(13, _padded(key % 45 + 11, 3)),
        "hcpcs": F.when(
            urgent & (status == "P"), _one_of(fixed.EMERGENCY_HCPCS, key)
        ).otherwise(_padded(F.col("part1"), CODE_WIDTH)),
        "revcode": F.when(
            urgent & (key % 3 == 0), _one_of(fixed.EMERGENCY_REVENUE, key)
        ).otherwise(_padded(key % 1000, 4)),
        **{
            f"icdproc{n}": _padded(F.col(f"part{n}"), CODE_WIDTH)
            for n in range(1, SLOT_COUNT + 1)
        },
        "mr_line_case": null_every(
            229,
            F.when(status == "F", by_parity("I12", "I12a"))
            .when(status == "O", by_parity("O12", "O12b"))
            .otherwise(by_parity("I11", "O11")),
        ),
        "mr_allowed": null_every(233, F.round(F.col("o_totalprice") * 100).cast("long")),
        "prm_acute_transfer_to_acute_yn": F.when(priority == "2-HIGH", F.lit("Y")).otherwise(
            F.lit("N")
        ),
        "prm_prv_id_operating": null_every(17, F.concat(F.lit("P"), (key % 100).cast("string"))),
        "paiddate": days_after(40),
    }
    lines = table(spark, sf_dir, "orders").join(
        _lines(table(spark, sf_dir, "lineitem")), F.col("o_orderkey") == F.col("l_orderkey"), "left"
    )
    return lines.select(*[columns[name].alias(name) for name in CLAIMS.names])


def code_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All codes of all three types, as the category files would hold them together."""
    parts = table(spark, sf_dir, "part")
    category = F.concat(F.lit("ccs"), (F.col("p_size") + 110).cast("string"))
    code = _padded(F.col("p_partkey"), CODE_WIDTH)
    brand = F.lpad(F.regexp_replace("p_brand", "Brand#", ""), 3, "0")

    def entries(part_types: tuple[str, ...], *fields: Column) -> DataFrame:
        named = [f.alias(n) for f, n in zip(fields, CODES.names, strict=True)]
        return parts.where(F.col("p_type").isin(*part_types)).select(*named)

    icd = entries(ICD_PART_TYPES, code, F.col("p_name"), F.lit("ICD10_PROC"), category)
    hcpcs = entries(HCPCS_PART_TYPES, code, F.col("p_name"), F.lit("CPT_HCPCS"), category)
    drg = entries(DRG_PART_TYPES, brand, F.col("p_brand"), F.lit("MSDRG"), category)
    return icd.unionAll(hcpcs).unionAll(drg.distinct())


def code_tables(spark: SparkSession, sf_dir: str) -> dict[str, DataFrame]:
    """The code table split into icd_procs, hcpcs and drg."""
    return split_codes(code_table(spark, sf_dir))
