"""Declared schemas of the landed files (inference would cost an extra pass over all of them)."""

from __future__ import annotations

from pyspark.sql import types as T

CORRUPT = "_corrupt_record"


def _struct(**fields: T.DataType) -> T.StructType:
    return T.StructType([T.StructField(name, kind) for name, kind in fields.items()])


_S, _I, _L, _D = T.StringType(), T.IntegerType(), T.LongType(), T.DoubleType()

# Field names of the landed files.
LEVEL = _struct(
    dato_Id=_S, omrType=_S, omrnr=_I, iso_aar=_I, iso_uke=_I, fyllingsgrad=_D, kapasitet_TWh=_D,
    fylling_TWh=_D, neste_Publiseringsdato=_S, fyllingsgrad_forrige_uke=_D, endring_fyllingsgrad=_D,
)
BENCHMARK = _struct(
    omrType=_S, omrnr=_I, iso_uke=_I, minFyllingsgrad=_D, minFyllingTWH=_D, medianFyllingsGrad=_D,
    medianFylling_TWH=_D, maxFyllingsgrad=_D, maxFyllingTWH=_D,
)
AREA = _struct(navn=_S, navn_langt=_S, beskrivelse=_S, omrType=_S, omrnr=_I)
GRID = _struct(
    Theme=_S, FullName=_S, NoDataValue=_I, X=_L, Y=_L, StartDate=_S, EndDate=_S, PrognoseStartDate=_S,
    Unit=_S, TimeResolution=_I, Altitude=_I, Data=T.ArrayType(_D),
)
STATION = _struct(
    id=_S, name=_S, shortName=_S, municipality=_S, county=_S, masl=_I,
    geometry=_struct(coordinates=T.ArrayType(_D)),
)
OBSERVATION = _struct(
    sourceId=_S, referenceTime=_S,
    observations=T.ArrayType(_struct(elementId=_S, value=_D, timeOffset=_S, qualityCode=_I)),
)
POINT_SEED = _struct(
    point_id=_S, area_code=_S, name=_S, latitude=_D, longitude=_D, utm33_x=_L, utm33_y=_L, comment=_S,
)
STATION_SEED = _struct(station_id=_S, area_code=_S, comment=_S)


def with_corrupt(schema: T.StructType) -> T.StructType:
    """The schema plus the column that keeps the text of a record that could not be read."""
    return T.StructType([*schema.fields, T.StructField(CORRUPT, _S)])
