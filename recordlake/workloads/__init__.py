"""Registered checks over the driver tables.

Each module defines ``QUERIES`` (name -> callable(spark, sf_dir) -> DataFrame)
and ``ORACLE`` (name -> DuckDB SQL over the same tables). The drifted
"vintages" are derived from the driver tables with Spark projections, then the
library operators run on them for real; the SQL states the expected result
directly.
"""

from recordlake.workloads import (  # noqa: F401
    harmonise, standardise, dedupe, profile, discovery, manifest, layout, sources, flows, streaming, scalars,
)

MODULES = [harmonise, standardise, dedupe, profile, discovery, manifest, layout, sources, flows, streaming,
           scalars]


def prepare(spark, sf_dir: str) -> None:
    """Write the derived input files that several checks read (fixture setup,
    reused within the session)."""
    flows.stage_lca(spark, sf_dir)
    flows.stage_perm(spark, sf_dir)
    flows.stage_pw(spark, sf_dir)


def all_queries() -> dict:
    out: dict = {}
    for m in MODULES:
        out.update(m.QUERIES)
    return out


def all_oracles() -> dict:
    out: dict = {}
    for m in MODULES:
        out.update(m.ORACLE)
    return out
