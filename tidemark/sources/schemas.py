"""Column names and types of the landing tables, source names and labels."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql.types import DoubleType, IntegerType, StringType, StructField, StructType


def _schema(**fields) -> StructType:
    return StructType([StructField(name, data_type) for name, data_type in fields.items()])


SERIES_SCHEMA = _schema(
    fonte=StringType(),
    indicador=StringType(),
    data=StringType(),
    ano=IntegerType(),
    mes=IntegerType(),
    valor=DoubleType(),
    unidade=StringType(),
    dt_carga=StringType(),
)
GDP_SCHEMA = _schema(
    fonte=StringType(),
    indicador=StringType(),
    periodo=StringType(),
    ano=IntegerType(),
    trimestre=IntegerType(),
    valor=DoubleType(),
    unidade=StringType(),
    dt_carga=StringType(),
)
POPULATION_SCHEMA = _schema(
    fonte=StringType(),
    indicador=StringType(),
    uf=StringType(),
    ano=IntegerType(),
    valor=DoubleType(),
    unidade=StringType(),
    dt_carga=StringType(),
)


@dataclass(frozen=True)
class Source:
    """A landing file, the bronze table it goes to and the schemas its header may follow."""

    name: str
    group: str
    schema: StructType

    @property
    def agency(self) -> str:
        return self.name.split("_")[0]


# The GDP file may hold quarterly rows or, from its stand-in, monthly ones: both headers bind.
GDP_FIELDS = StructType(GDP_SCHEMA.fields + [SERIES_SCHEMA["data"], SERIES_SCHEMA["mes"]])

SOURCES = {
    source.name: source
    for source in (
        Source("ibge_pib", "pib", GDP_FIELDS),
        Source("ibge_populacao", "populacao", POPULATION_SCHEMA),
        Source("bcb_selic", "series_bcb", SERIES_SCHEMA),
        Source("bcb_ipca", "series_bcb", SERIES_SCHEMA),
        Source("bcb_cambio", "series_bcb", SERIES_SCHEMA),
        Source("ipea_desemprego", "series_ipea", SERIES_SCHEMA),
        Source("ipea_gini", "series_ipea", SERIES_SCHEMA),
    )
}

# Bronze groups that feed the observation table, with the category of their rows.
CATEGORIES = {"series_bcb": "monetario", "series_ipea": "social", "pib": "atividade"}


def select_sources(names=None) -> list[Source]:
    """The named sources, or all of them."""
    unknown = set(names or ()) - SOURCES.keys()
    if unknown:
        raise KeyError(f"unknown sources: {', '.join(sorted(unknown))}")
    return [SOURCES[name] for name in (names or SOURCES)]
