"""Declared schemas of every table and document the library reads or writes.

Nothing on the main paths is inferred: a declared schema makes absent JSON fields
null, keeps the scan to one pass and lets Spark prune nested columns.
"""

from __future__ import annotations

from pyspark.sql import types as T


def _strings(*names: str) -> list[T.StructField]:
    return [T.StructField(n, T.StringType(), True) for n in names]


LOAD_COLUMNS = [
    T.StructField("Load_Date", T.DateType(), False),
    T.StructField("KSU_LOESCH_DATUM", T.DateType(), False),
]

# Delivered column names, in delivered order.
MODPROD_HEADER = ["MODEL", "MODEL_YEAR", "SALES_CLASS", "PRODUCT"]
MODKPB_HEADER = ["MODEL", "SALES_CLASS", "PRODUCT", "KPB"]
# The names the same columns carry in the stored tables.
MODPROD_COLUMNS = ["Model", "Model_Year", "Sales_Class", "Product"]
MODKPB_COLUMNS = ["Model", "Sales_Class", "Product", "KPB"]
# Positional names of the headerless interface file.
INTERFACE_COLUMNS = [
    "modell",
    "modelljahr",
    "fahrzeugklasse",
    "produktkennzeichen",
    "konzernprojektbezeichnung",
]

MODPROD_DELIVERED = T.StructType(_strings(*MODPROD_HEADER) + LOAD_COLUMNS)
MODKPB_DELIVERED = T.StructType(_strings(*MODKPB_HEADER) + LOAD_COLUMNS)
MODPROD_STORED = T.StructType(_strings(*MODPROD_COLUMNS) + LOAD_COLUMNS)
MODKPB_STORED = T.StructType(_strings(*MODKPB_COLUMNS) + LOAD_COLUMNS)

# class name -> (delivered header, stored names)
CORE_CLASSES: dict[str, tuple[list[str], list[str]]] = {
    "modprod": (MODPROD_HEADER, MODPROD_COLUMNS),
    "modkpb": (MODKPB_HEADER, MODKPB_COLUMNS),
}
DELIVERED_SCHEMAS = {"modprod": MODPROD_DELIVERED, "modkpb": MODKPB_DELIVERED}
STORED_SCHEMAS = {"modprod": MODPROD_STORED, "modkpb": MODKPB_STORED}

ECU_VERSION = T.StructType(
    _strings("hardwareVersion", "softwareVersion", "hardwarePartNumber")
    + [T.StructField("frozenStatus", T.StructType(_strings("abbreviation")), True)]
)
MATERIAL = T.StructType(
    _strings("partNumber", "naming", "materialType")
    + [
        T.StructField("diagnosisAddresses", T.ArrayType(T.StringType()), True),
        T.StructField("ecuVersions", T.ArrayType(ECU_VERSION), True),
    ]
)
BASELINE_CONTENT = T.StructType(
    _strings("productId", "status")
    + [T.StructField("materials", T.ArrayType(MATERIAL), True)]
)
BASELINE_DOCUMENT = T.StructType([T.StructField("content", BASELINE_CONTENT, True)])
OVERVIEW_DOCUMENT = T.StructType(
    [T.StructField("content", T.ArrayType(T.StructType(_strings("uuid"))), True)]
)

# The nine attributes that identify a flattened baseline row.
BASELINE_KEYS = [
    "partNumber",
    "naming",
    "materialType",
    "diagnosisAddresses",
    "hardwareVersion",
    "softwareVersion",
    "hardwarePartNumber",
    "abbreviation",
    "productId",
]
BASELINE_COLUMNS = [*BASELINE_KEYS, "validfrom", "KSU_LOESCH_DATUM"]
BASELINE_STORED = T.StructType(
    _strings(*BASELINE_KEYS, "validfrom")
    + [T.StructField("KSU_LOESCH_DATUM", T.DateType(), True)]
)

RAW_RESPONSE = T.StructType(
    _strings("url", "product_id", "uuid")
    + [T.StructField("status", T.IntegerType(), True)]
    + _strings("body")
)
# A response as it lands, and what a baseline file's line can be: a document or such a row.
LANDED_RESPONSE = T.StructType(_strings("object_key", "product_id", "uuid", "body"))
LANDED_BASELINE = T.StructType([*BASELINE_DOCUMENT.fields, *_strings("body")])

LOAD_LOG = T.StructType(
    _strings("table_name", "load_id", "operation")
    + [
        T.StructField("rows_written", T.LongType(), True),
        T.StructField("committed_at", T.TimestampType(), True),
    ]
)


def maintenance_control(task: str) -> T.StructType:
    """Control table of one maintenance task (``vacuum`` or ``optimize``).

    The run dates are real dates here; only vacuum keeps files for a retention time.
    """
    fields = _strings("table_name", "s3_table_path") + [
        T.StructField("days", T.IntegerType(), True),
        T.StructField(f"{task}_flag", T.BooleanType(), True),
    ]
    if task == "vacuum":
        fields.append(T.StructField("retention_days", T.IntegerType(), True))
    return T.StructType(
        fields
        + [
            T.StructField(f"{task}_last_run", T.DateType(), True),
            T.StructField(f"{task}_next_run", T.DateType(), True),
        ]
    )


VACUUM_CONTROL = maintenance_control("vacuum")
OPTIMIZE_CONTROL = maintenance_control("optimize")
