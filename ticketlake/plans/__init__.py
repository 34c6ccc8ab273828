"""End-to-end commands as one Spark plan each."""


def release(result: dict) -> None:
    """Unpersist the intermediate sets a command cached (``classify`` and
    ``close`` list them under ``"persisted"``); call it once every output
    that is needed has been written."""
    for df in result.get("persisted", []):
        df.unpersist()
