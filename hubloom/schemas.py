"""Table schemas. Ids are opaque strings; null and "" are different values."""

from __future__ import annotations

from pyspark.sql.types import (
    ArrayType, BooleanType, DoubleType, IntegerType, LongType, MapType,
    StringType, StructField, StructType, TimestampNTZType, TimestampType,
    VariantType,
)


def _fields(**columns) -> StructType:
    return StructType([StructField(name, kind, True) for name, kind in columns.items()])


_S, _L, _I, _B = StringType(), LongType(), IntegerType(), BooleanType()

HUB = _fields(id=_S, name=_S, hash=_S, device_local_ids=ArrayType(_S))

DEVICE = _fields(id=_S, local_id=_S, name=_S, device_type_id=_S)

# Content variables nest without a fixed depth, so they stay variants.
CONTENT = _fields(id=_S, content_variable=VariantType(), serialization=_S,
                  protocol_segment_id=_S)

SERVICE = _fields(
    id=_S, local_id=_S, name=_S, description=_S, interaction=_S,
    aspect_ids=ArrayType(_S), protocol_id=_S, inputs=ArrayType(CONTENT),
    outputs=ArrayType(CONTENT), function_ids=ArrayType(_S), rdf_type=_S,
)

DEVICE_TYPE = _fields(id=_S, name=_S, device_class_id=_S, services=ArrayType(SERVICE))

PROCESS_MODEL = _fields(
    _id=_S, name=_S, date=_L, owner=_S, bpmn_xml=_S, svgXML=_S, publish=_B,
    publish_date=_S, description=_S,
)

PERMISSION = _fields(user_id=_S, kind=_S, id=_S, right=_S, allowed=_B)

FILTER_CRITERIA = _fields(characteristic_id=_S, function_id=_S,
                          device_class_id=_S, aspect_id=_S)

SELECTABLE = _fields(
    device=_fields(id=_S, name=_S),
    services=ArrayType(_fields(id=_S, name=_S)),
)

SELECTION = _fields(
    filter_criteria=FILTER_CRITERIA, selection_options=ArrayType(SELECTABLE),
    selected_device_id=_S, selected_service_id=_S, selected_device_group_id=_S,
    selected_import_id=_S, selected_generic_event_source=_S,
    selected_path=VariantType(),
)

TASK = _fields(retries=_L, parameter=MapType(_S, _S), selection=SELECTION)

ELEMENT = _fields(
    bpmn_id=_S, group=_S, name=_S, order=_L,
    time_event=_fields(type=_S, time=_S),
    notification=_fields(title=_S, message=_S),
    message_event=_fields(value=_S, flow_id=_S, event_id=_S, selection=SELECTION),
    conditional_event=_fields(script=_S, value_variable=_S, selection=SELECTION),
    task=TASK,
)

DEPLOYMENT = _fields(
    version=_I, id=_S, name=_S, description=_S,
    diagram=_fields(xml_raw=_S, xml_deployed=_S, svg=_S),
    elements=ArrayType(ELEMENT), executable=_B,
    incident_handling=_fields(restart=_B, notify=_B),
)

DEPLOYMENT_COMMAND = _fields(command=_S, id=_S, version=_I, owner=_S, source=_S,
                             deployment=DEPLOYMENT)

PREPARE_REQUEST = _fields(xml=_S, svg=_S)

VARIABLE = _fields(value=VariantType(), type=_S, valueInfo=VariantType())

SYNC_METADATA = _fields(
    camunda_deployment_id=_S, process_parameter=MapType(_S, VARIABLE),
    deployment_model=DEPLOYMENT, network_id=_S, is_placeholder=_B,
    marked_for_delete=_B, sync_date=TimestampType(),
)

PROCESS_INSTANCE = _fields(
    id=_S, definitionId=_S, businessKey=_S, caseInstanceId=_S, ended=_B,
    suspended=_B, tenantId=_S, network_id=_S, is_placeholder=_B,
    marked_for_delete=_B, sync_date=TimestampType(),
)

HISTORIC_PROCESS_INSTANCE = _fields(
    id=_S, superProcessInstanceId=_S, superCaseInstanceId=_S, caseInstanceId=_S,
    processDefinitionName=_S, processDefinitionKey=_S,
    processDefinitionVersion=DoubleType(), processDefinitionId=_S,
    businessKey=_S, startTime=_S, endTime=_S, durationInMillis=DoubleType(),
    startUserId=_S, startActivityId=_S, deleteReason=_S, tenantId=_S, state=_S,
    network_id=_S, is_placeholder=_B, marked_for_delete=_B,
    sync_date=TimestampType(),
)

TOPIC_MESSAGE = _fields(topic=_S, payload=_S, ts=TimestampType())

# What is sent to hubs; a row of any action leaves what it lacks null.
COMMAND = _fields(action_id=_S, network_id=_S, deployment_id=_S, engine_id=_S, seq=_S,
                  command_key=_S, source=_S, body=_S, run_id=_S, action=_S)

TABLES = {
    "commands": COMMAND,
    "hubs": HUB,
    "devices": DEVICE,
    "device_types": DEVICE_TYPE,
    "services": SERVICE,
    "process_models": PROCESS_MODEL,
    "permissions": PERMISSION,
    "deployments": DEPLOYMENT,
    "sync_metadata": SYNC_METADATA,
    "process_instances": PROCESS_INSTANCE,
    "historic_process_instances": HISTORIC_PROCESS_INSTANCE,
    "topic_messages": TOPIC_MESSAGE,
}

# Parquet tables the registered queries read.
DRIVER_TABLES = {
    "customer": _fields(c_custkey=_L, c_name=_S, c_nationkey=_I,
                        c_acctbal=DoubleType(), c_mktsegment=_S),
    "supplier": _fields(s_suppkey=_L, s_name=_S, s_nationkey=_I, s_acctbal=DoubleType()),
    "part": _fields(p_partkey=_L, p_name=_S, p_brand=_S, p_type=_S, p_size=_I,
                    p_retailprice=DoubleType()),
    "orders": _fields(o_orderkey=_L, o_custkey=_L, o_orderstatus=_S,
                      o_totalprice=DoubleType(), o_orderdate=TimestampNTZType(),
                      o_orderpriority=_S),
    "lineitem": _fields(
        l_orderkey=_L, l_partkey=_L, l_suppkey=_L, l_linenumber=_I,
        l_quantity=DoubleType(), l_extendedprice=DoubleType(),
        l_discount=DoubleType(), l_tax=DoubleType(), l_returnflag=_S,
        l_linestatus=_S, l_shipdate=TimestampNTZType()),
    "events": _fields(event_id=_L, ts=TimestampNTZType(), user_id=_L, event_type=_S,
                      value=DoubleType(), props=_S),
    "pages": _fields(page_id=_L, url=_S, html=_S),
}
