"""The source's stages as DataFrame plans.

* ``clean_items``    -- trace B: raw all-text items -> cleaned flat rows.
* ``build_documents``-- trace C: cleaned rows -> nested documents.
* ``load_collection``-- trace C sink: full refresh + keyed upsert into a
                        versioned snapshot, with write counters.
* ``multi_type_count`` / ``water_after_level`` (in ``operators.lookup``) --
                        trace D.

Order inside ``clean_items`` follows the source because it changes results
and cost: ids are normalised, then deduplicated (one shuffle on the id), and
only then are the expensive literal decoders run, fused in one projection.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions import nested as N
from ..functions import scalars as S
from ..operators import conform, dedup, merge

# ---------------------------------------------------------------------------
# Column and field names of the source's files and documents
# (raw item columns, the rich columns exempt from the all-null drop, the
# cleaned columns in order, the raw columns dropped after cleaning, and the
# document schema below).
# ---------------------------------------------------------------------------
RAW_COLUMNS = ["numero", "url", "nome", "proximas_evolucoes", "tamanho", "peso", "tipos",
               "efetividade", "habilidades"]
RICH_COLUMNS = ("proximas_evolucoes", "habilidades", "efetividade")
DROPPED_RAW = ["tamanho", "peso", "proximas_evolucoes", "efetividade", "habilidades"]
SEQ = "seq"   # ours: explicit input order

CLEAN_SCHEMA = T.StructType([
    T.StructField("numero", T.StringType()),   # canonical digits, unbounded
    T.StructField("url", T.StringType()),
    T.StructField("nome", T.StringType()),
    T.StructField("tipos", T.StringType()),
    T.StructField("Peso_kg", T.DoubleType()),
    T.StructField("altura_cm", T.DoubleType()),
    T.StructField("efetividade_dict", T.MapType(T.StringType(), T.DoubleType())),
    T.StructField("habilidades_nomes", T.StringType()),
    T.StructField("habilidades_urls", T.StringType()),
    T.StructField("habilidades_descricoes", T.StringType()),
    T.StructField("numero_evol", T.StringType()),
    T.StructField("level_evol", T.StringType()),
    T.StructField("item_evol", T.StringType()),
    T.StructField("nome_evol", T.StringType()),
    T.StructField("url_evol", T.StringType()),
])

HABILIDADE = T.StructType([T.StructField(f, T.StringType()) for f in N.HABILIDADE_FIELDS])
DOCUMENT_SCHEMA = T.StructType([
    T.StructField("numero", T.LongType()),
    T.StructField("url", T.StringType()),
    T.StructField("nome", T.StringType()),
    T.StructField("tipos", T.ArrayType(T.StringType())),
    T.StructField("peso_kg", T.DoubleType()),
    T.StructField("altura_cm", T.DoubleType()),
    T.StructField("efetividade", T.MapType(T.StringType(), T.DoubleType())),
    T.StructField("habilidades", T.ArrayType(HABILIDADE)),
    T.StructField("evolucao", T.StructType([
        T.StructField("numero", T.LongType()),
        T.StructField("nome", T.StringType()),
        T.StructField("url", T.StringType()),
        T.StructField("condicao", T.StructType([
            T.StructField("level", T.IntegerType()),
            T.StructField("item", T.StringType())]))])),
])
# ---------------------------------------------------------------------------


def clean_items(raw: DataFrame, seq: str = SEQ, wide: bool = False) -> DataFrame:
    """Trace B. ``raw`` holds the raw item columns as text plus ``seq`` (input
    order, needed for keep-first). Absent columns are tolerated (P1/P3).
    ``wide``, for columnar input: keep-first aggregates (id, order) alone and
    picks the rows by a join, so no literal is carried through an aggregate."""
    if seq not in raw.columns:
        raise ValueError(f"raw items need an explicit input order column '{seq}'")
    df = conform.derive_if_present(raw, {"numero": ("numero", S.canonical_digits)})
    if "numero" in df.columns:
        df = dedup.keep_first(df, "numero", seq, wide=wide)
    df = conform.drop_all_null(df, exclude=RICH_COLUMNS + (seq,))
    derived = {
        "Peso_kg": ("peso", S.parse_decimal),
        "altura_cm": ("tamanho", S.length_to_cm),
        "efetividade_dict": ("efetividade", N.decode_literal_map),
        "_evo": ("proximas_evolucoes", N.decode_evolutions),
        "_hab": ("habilidades", lambda c: N.decode_records_joined(c, tuple(N.HABILIDADE_FIELDS))),
        "tipos": ("tipos", S.normalize_list_text),
    }
    df = conform.derive_if_present(df, derived)
    flat = {}
    if "_evo" in df.columns:
        flat.update({c: F.col(f"_evo.{c}") for c in N.EVOLUTION_COLUMNS})
    if "_hab" in df.columns:
        flat.update({f"habilidades_{p}": F.col(f"_hab.{f}") for f, p in
                     zip(N.HABILIDADE_FIELDS, ("nomes", "urls", "descricoes"))})
    if flat:
        df = df.withColumns(flat)
    df = conform.drop_if_present(df, DROPPED_RAW + ["_evo", "_hab"])
    return conform.conform(df, _with_seq(CLEAN_SCHEMA, seq))


def _with_seq(schema: T.StructType, seq: str) -> T.StructType:
    return T.StructType(list(schema.fields) + [T.StructField(seq, T.LongType())])


def build_documents(clean: DataFrame, seq: str = SEQ) -> DataFrame:
    """Trace C. Accepts the typed cleaned frame or its all-text CSV form."""
    df = conform.drop_unnamed(clean)
    kept = T.StructType([T.StructField(f.name, df.schema[f.name].dataType if f.name in df.columns
                                       else T.StringType()) for f in CLEAN_SCHEMA.fields])
    df = conform.conform(df, _with_seq(kept, seq))
    types = {f.name: f.dataType for f in df.schema.fields}
    text = lambda c: S.null_tokens(c, False)
    tipos = F.coalesce(S.split_clean(text(F.col("tipos")), ","), F.array().cast("array<string>"))
    eff = types["efetividade_dict"]
    efetividade = (F.transform_values(F.col("efetividade_dict"), lambda k, v: v.cast("double"))
                   if isinstance(eff, T.MapType) else N.decode_literal_map("efetividade_dict"))
    doc = df.select(
        S.to_int(F.col("numero").cast("string"), False).alias("numero"),
        text(F.col("url")).alias("url"),
        text(F.col("nome")).alias("nome"),
        tipos.alias("tipos"),
        S.to_float(F.col("Peso_kg").cast("string")).alias("peso_kg"),
        S.to_float(F.col("altura_cm").cast("string")).alias("altura_cm"),
        F.coalesce(efetividade, N.empty_map()).alias("efetividade"),
        N.rebuild_records("habilidades_nomes", "habilidades_urls", "habilidades_descricoes").alias("habilidades"),
        N.build_evolution(*N.EVOLUTION_COLUMNS).alias("evolucao"),
        F.col(seq))
    return doc


def overflow_counts(clean: DataFrame) -> DataFrame:
    """M8: one row with the values that the load has to leave out because their
    number exceeds the field's type: ``numero``, ``evolucao_numero`` (64 bits)
    and ``evolucao_level`` (32 bits)."""
    def over(column: str, kind: str) -> Column:
        if column not in clean.columns:
            return F.lit(0)
        parts = F.split(F.col(column).cast("string"), S.JOIN_SEP)
        exceeds = F.filter(F.transform(parts, lambda p: S.first_digits(p, False)),
                           lambda d: d.isNotNull() & d.try_cast(kind).isNull())
        return F.coalesce(F.sum(F.size(F.coalesce(exceeds, F.array().cast("array<string>")))), F.lit(0))

    return clean.agg(over("numero", "bigint").cast("bigint").alias("numero"),
                     over("numero_evol", "bigint").cast("bigint").alias("evolucao_numero"),
                     over("level_evol", "int").cast("bigint").alias("evolucao_level"))


def load_collection(docs: DataFrame, seq: str = SEQ) -> DataFrame:
    """Trace C sink: the collection is reset (full refresh), then every
    document is upserted by ``numero``, else by ``nome``. Returns the merged
    snapshot with its ``op`` column; ``merge.write_counters`` gives the
    counters and ``sources.snapshot.write_snapshot`` persists it."""
    from ..session import materialize
    spark = docs.sparkSession
    empty = spark.createDataFrame([], DOCUMENT_SCHEMA)
    # The documents feed three merge branches (keyed fold, key-less fold,
    # target choice); written once, like the source's cleaned file.
    return merge.upsert(empty, materialize(docs, "documents"), "numero", "nome", seq)
