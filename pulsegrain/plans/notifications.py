"""YANG-push notification messages: a gate on the encoding deep inside the envelope, and the message as the one row."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from pulsegrain.functions import variants as V
from pulsegrain.operators.routing import gate
from pulsegrain.specs import Pipeline

# Names in the messages.
MESSAGE = "ietf-telemetry-message:message"
ENCODING = (
    MESSAGE, "telemetry-message-metadata", "ietf-yang-push-telemetry-message:yang-push-subscription", "encoding",
)
JSON_ENCODING = "ietf-subscribed-notifications:encode-json"


def door(doc: Column) -> Column:
    """Pass messages whose encoding is JSON, given as a text or as the name of a field; keep nothing but the message."""
    encoding = V.Place(doc).at(*ENCODING)
    accepted = F.coalesce(encoding.text == F.lit(JSON_ENCODING), F.lit(False)) | encoding.at(JSON_ENCODING).value.isNotNull()
    return gate(V.pick(doc, [MESSAGE]), accepted)


def pipeline(tag: str = "ietf-notifications", topic: str = "notifications") -> Pipeline:
    return Pipeline(tag=tag, topic=topic, match={"jsonpath": f"$['{MESSAGE}']"})
