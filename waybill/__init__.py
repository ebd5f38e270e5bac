"""Message-driven file loads and message routing on Spark."""

from waybill.layouts import DEFAULT_REGISTRY, Registry, SourceLayout, struct
from waybill.operators.messages import messages_frame, parse_messages
from waybill.operators.tables import SchemaMismatch, Targets, create_load_tables
from waybill.plans.dynamic import JsonRouting
from waybill.plans.exact_name import ExactNameLoad
from waybill.plans.inferred import InferredLoad
from waybill.plans.load import FileLoad, judged_lines, load_file
from waybill.plans.router import dispatch

__all__ = [
    "DEFAULT_REGISTRY",
    "ExactNameLoad",
    "FileLoad",
    "InferredLoad",
    "JsonRouting",
    "Registry",
    "SchemaMismatch",
    "SourceLayout",
    "Targets",
    "create_load_tables",
    "dispatch",
    "judged_lines",
    "load_file",
    "messages_frame",
    "parse_messages",
    "struct",
]
