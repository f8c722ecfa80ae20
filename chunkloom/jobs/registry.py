"""All registered queries of the measurement operators, and their SQL."""

from __future__ import annotations

from chunkloom.jobs import fields, fits, geometry, graphs, labels, measures, mesh, order, planning, profiles, records, registration, statistics, stencils, volumes
from chunkloom.streaming import slabs

QUERIES: dict = {}
ORACLE_SQL: dict[str, str] = {}
for _module in (labels, graphs, geometry, statistics, order, planning, measures, mesh, fits, fields, stencils, records, registration, profiles, volumes, slabs):
    QUERIES |= _module.JOBS.queries
    ORACLE_SQL |= _module.JOBS.sql
