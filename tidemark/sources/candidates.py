"""From payload files to landing files: each source has candidates in order, and the first that yields rows is landed.

Fetching is not part of this library. A fetched document of candidate ``n`` of a source lies below ``<payloads>/<source>/<n>``; a
candidate whose fetch failed has no folder, or an empty document.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.sources.landing import first_nonempty, path_exists, write_csv
from tidemark.sources.payloads import flatten_odata, flatten_sgs, flatten_sidra, flatten_sidra_region, read_payloads
from tidemark.sources.schemas import select_sources


@dataclass(frozen=True)
class Candidate:
    """A payload kind, what its rows are called, and the series (or table) that it is fetched from."""

    kind: str
    series: str
    indicator: str
    unit: str
    year: int | None = None


# Which series stand for a source, in order of preference.
CANDIDATES = {
    "ibge_pib": (
        Candidate("sidra", "5932/6561 by list of years", "pib_variacao_pct", "%"),
        Candidate("sidra", "5932/6561 by range of years", "pib_variacao_pct", "%"),
        Candidate("sidra", "1621/583", "pib_variacao_pct", "%"),
        Candidate("sgs", "4380", "pib_variacao_pct", "%"),
    ),
    "ibge_populacao": tuple(Candidate("sidra_region", "6579/9324", "populacao", "pessoas", year) for year in (2022, 2021, 2020)),
    "bcb_selic": (Candidate("sgs", "4189", "selic_mensal", "% a.a."),),
    "bcb_ipca": (Candidate("sgs", "433", "ipca_mensal", "%"),),
    "bcb_cambio": (Candidate("sgs", "3698", "cambio_usd_brl", "R$/USD"),),
    "ipea_desemprego": (Candidate("odata", "PNADC12_TDESOC12", "desemprego_pct", "%"),),
    "ipea_gini": (
        Candidate("odata", "PNADC12_RDPCHABR12", "renda_media_pc", "R$"),
        Candidate("odata", "PNADC12_RDPC12", "renda_media_pc", "R$"),
        Candidate("odata", "GAP_GINI", "gini", "índice"),
        Candidate("sgs", "7326", "renda_media_pc", "R$"),
        Candidate("sgs", "28544", "renda_media_pc", "R$"),
    ),
}


def payload_path(payload_dir: str, source: str, place: int) -> str:
    return f"{payload_dir}/{source}/{place}"


def candidate_rows(spark: SparkSession, payload_dir: str, source: str, place: int, loaded_at=None) -> DataFrame | None:
    """Landing rows of one candidate; None if nothing was fetched for it."""
    path, candidate = payload_path(payload_dir, source, place), CANDIDATES[source][place]
    if not path_exists(spark, path):
        return None
    raw = read_payloads(spark, path)
    if candidate.kind == "sidra_region":
        return flatten_sidra_region(raw, candidate.indicator, candidate.unit, F.lit(candidate.year), loaded_at=loaded_at)
    flatten = {"sidra": flatten_sidra, "sgs": flatten_sgs, "odata": flatten_odata}[candidate.kind]
    return flatten(raw, candidate.indicator, candidate.unit, loaded_at=loaded_at)


def land_sources(spark: SparkSession, payload_dir: str, raw_dir: str, names=None, loaded_at=None) -> list[str]:
    """Write the first candidate with rows of each source to ``<raw_dir>/<source>.csv``; returns the sources that were landed.

    A source without any fetched payload is skipped. If all its candidates are empty, the last one is landed: a file with a header only.
    """
    landed = []
    for source in select_sources(names):
        found = [candidate_rows(spark, payload_dir, source.name, place, loaded_at) for place in range(len(CANDIDATES[source.name]))]
        found = [rows for rows in found if rows is not None]
        if found:
            write_csv(first_nonempty(found), f"{raw_dir}/{source.name}.csv")
            landed.append(source.name)
    return landed
