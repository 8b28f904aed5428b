import json

import pytest

from harborline.session import build_session, shared_dir

SF_DIR = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    session = build_session(
        "harborline-tests", "local[8]",
        **{"spark.sql.shuffle.partitions": "8", "spark.ui.enabled": "false", "spark.ui.showConsoleProgress": "false",
           "spark.driver.memory": "4g"},
    )
    session.sparkContext.setLogLevel("OFF")
    shared_dir(session)
    yield session
    session.stop()


@pytest.fixture(scope="session")
def sf_dir():
    return SF_DIR


def as_lines(spark, *objects):
    """One-column frame of text lines; strings are taken as they are."""
    rows = [(o if isinstance(o, str) else json.dumps(o),) for o in objects]
    return spark.createDataFrame(rows, "value string")


def position(ship="ship-001", ts="2026-03-26T18:40:00", origin="Shanghai", dest="Algeciras", lat=15.2, lon=72.5, speed=19.5, heading=255.0):
    return {
        "event_type": "ship_position", "ts": ts, "ship_id": ship, "route_id": f"route-{origin.lower()}-{dest.lower()}",
        "origin_port": origin, "dest_port": dest, "lat": lat, "lon": lon, "speed_kn": speed, "heading": heading,
    }


# Sample voyages: the positions shown in the topic documentation.
SAMPLE_POSITIONS = [
    position("ship-001", "2026-03-26T18:40:00", "Shanghai", "Algeciras", 15.2, 72.5, 19.5, 255.0),
    position("ship-002", "2026-03-26T18:45:00", "Shanghai", "Valencia", 18.5, 65.0, 18.2, 272.0),
    position("ship-003", "2026-03-26T18:50:00", "Shanghai", "Barcelona", 22.0, 55.0, 17.4, 305.0),
    position("ship-004", "2026-03-26T18:52:00", "Yokohama", "Algeciras", 28.0, 55.0, 20.3, 282.0),
    position("ship-005", "2026-03-26T18:55:00", "Yokohama", "Valencia", 32.0, 42.0, 18.9, 286.0),
    position("ship-006", "2026-03-26T19:00:00", "Yokohama", "Barcelona", 36.0, 25.0, 19.1, 278.0),
]
SAMPLE_SEVERITIES = {"clima": [3, 2], "noticias": [4, 2]}


@pytest.fixture(scope="session")
def sample_ships(spark):
    from harborline import schemas
    from harborline.operators import staging

    lines = as_lines(spark, *SAMPLE_POSITIONS)
    return staging.stage_ships(staging.parse_json(lines, schemas.SHIP_POSITION))
