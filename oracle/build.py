"""Put together self-contained statements: WITH the tables a query needs, then the query."""

from __future__ import annotations

import re

from oracle.answers import ANSWERS
from oracle.models import MODELS
from wardmart.sources.projections import DIAGNOSIS_PARTS, RAW_SQL, TABLES


def _plain(sql: str) -> str:
    return sql.format(**{t: t for t in TABLES})


def _definitions() -> dict[str, str]:
    raw = {name: _plain(sql) for name, sql in RAW_SQL.items()}
    raw["stg_ehp__diag"] = "\nunion all\n".join(_plain(sql) for sql in DIAGNOSIS_PARTS)
    return raw | MODELS


def oracle_queries() -> dict[str, str]:
    definitions = _definitions()
    uses = {name: _names_in(sql, definitions) for name, sql in definitions.items()}

    def needed(names: list[str], done: list[str]) -> list[str]:
        for name in names:
            if name not in done:
                needed(uses[name], done)
                done.append(name)
        return done

    statements = {}
    for key, sql in ANSWERS.items():
        tables = needed(_names_in(sql, definitions), [])
        ctes = ",\n".join(f"{name} as materialized (\n{definitions[name]}\n)" for name in tables)
        statements[key] = f"with {ctes}\n{sql}" if tables else sql
    return statements


def _names_in(sql: str, definitions: dict[str, str]) -> list[str]:
    words = dict.fromkeys(re.findall(r"\w+", sql))
    return [word for word in words if word in definitions and not re.search(rf"\b{word} as \(", sql)]
