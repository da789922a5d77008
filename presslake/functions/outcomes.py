"""Messages that tell how fetching one source went."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Outcome kinds and the wording of their messages.
FETCHED, HTTP_ERROR, OTHER_ERROR = "ok", "http_error", "error"


def outcome_message(kind: Column, source: Column, key: Column, error: Column) -> Column:
    detail = F.coalesce(error, F.lit(""))
    return (
        F.when(kind == FETCHED, F.concat(F.lit("Successfully uploaded "), source, F.lit(" to "), key))
        .when(kind == HTTP_ERROR, F.concat(F.lit("Error al descargar de "), source, F.lit(": "), detail))
        .otherwise(F.concat(F.lit("Error inesperado al procesar "), source, F.lit(": "), detail))
    )
