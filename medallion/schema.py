"""Column names, types and other values that are fixed by the client file format."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import types as T

# Column of the client CSV, name after landing, canonical name, type.
# The file's order is the declared order; the phone column is renamed on landing.
CLIENT_COLUMNS = (
    ("cod_cliente", "cod_cliente", "client_id", T.LongType()),
    ("nm_cliente", "nm_cliente", "name", T.StringType()),
    ("nm_pais_cliente", "nm_pais_cliente", "country", T.StringType()),
    ("nm_cidade_cliente", "nm_cidade_cliente", "city", T.StringType()),
    ("nm_rua_cliente", "nm_rua_cliente", "street", T.StringType()),
    ("num_casa_cliente", "num_casa_cliente", "house_no", T.StringType()),
    ("telefone_cliente", "num_telefone_cliente", "phone", T.StringType()),
    ("dt_nascimento_cliente", "dt_nascimento_cliente", "birth_date", T.DateType()),
    ("dt_atualizacao", "dt_atualizacao", "updated_at", T.TimestampNTZType()),
    ("tp_pessoa", "tp_pessoa", "person_type", T.StringType()),
    ("vl_renda", "vl_renda", "income", T.DecimalType(10, 2)),
)

# Lineage columns added on landing, original and canonical name.
LINEAGE_COLUMNS = (
    ("anomesdia", "load_date"),
    ("arquivo_fonte", "source_file"),
    ("dt_ingestao", "ingested_at"),
)

# Violation and analytics columns, original and canonical name.
RESULT_COLUMNS = (
    ("data_quality_offensor_cat", "rule"),
    ("offensor", "offender"),
    ("created_at", "checked_at"),
    ("qtd_atualizacoes", "updates"),
    ("media_idade_anos", "avg_age_years"),
)

# The kinds of person a client can be.
PERSON_TYPES = ("PF", "PJ")

# Accepted phone forms. Strict is what silver keeps, lenient is what the
# rule accepts. \A and \z, not ^ and $: Java's $ also matches before a last newline.
STRICT_PHONE = r"\A\(\d{2}\)\d{5}-\d{4}\z"
LENIENT_PHONE = r"\A\(\d{2}\)\s?\d{4,5}-\d{4}\z"

# Fixed value: a landing folder is one day, particao_YYYYMMDD (or Spark's own
# particao=YYYYMMDD when another Spark job wrote it).
DAY_FOLDER = r"particao[_=](\d{8})"
DAY_FOLDER_GLOB = "particao[_=]"

CANONICAL = {landed: name for _, landed, name, _ in CLIENT_COLUMNS} | dict(
    LINEAGE_COLUMNS + RESULT_COLUMNS
)
ORIGINAL = {name: landed for landed, name in CANONICAL.items()}
BUSINESS_COLUMNS = tuple(name for _, _, name, _ in CLIENT_COLUMNS)


# The header line of the original client files.
CLIENT_HEADER = tuple(in_file for in_file, _, _, _ in CLIENT_COLUMNS)


# Short names of the types in use, for ``struct``.
LONG, TEXT, DOUBLE = T.LongType(), T.StringType(), T.DoubleType()
DATE, TIME, MONEY = T.DateType(), T.TimestampNTZType(), T.DecimalType(10, 2)


def struct(**columns: T.DataType) -> T.StructType:
    return T.StructType([T.StructField(name, kind) for name, kind in columns.items()])


def client_schema() -> T.StructType:
    """Schema of the client CSV under canonical names, in the order of the file."""
    return T.StructType([T.StructField(name, kind) for _, _, name, kind in CLIENT_COLUMNS])


def to_canonical(df: DataFrame) -> DataFrame:
    """Rename original column names to canonical ones; other columns stay."""
    return df.withColumnsRenamed(CANONICAL)


def to_original(df: DataFrame) -> DataFrame:
    """Rename canonical column names back to the original ones."""
    return df.withColumnsRenamed(ORIGINAL)
