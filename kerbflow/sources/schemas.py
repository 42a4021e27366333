"""Declared schemas of the input tables, so that readers never infer them."""

from __future__ import annotations

from pyspark.sql.types import StructType

_DDL = {
    "traffic_status": """
        nodeid string, time bigint, active boolean, channel int, count bigint, data string,
        name string, type string, orgid string, siteid string, tags array<string>,
        trafficdetectioneventid string, updated string""",
    "traffic_current_status": """
        count bigint, aggregated_count bigint, trafficdetectioneventid string""",
    "parking_spot_historic": """
        siteid string, since bigint, channel int, nodeid string, objectid string,
        occupancy boolean, orgid string, parkinggroupid string, parkingspotid string,
        parkingzoneid string""",
    "parking_zone_status": """
        siteid string, orgid string, parkinggroupid string, parkingzoneid string,
        type string, config string""",
    "parking_spot_current": """
        parkingspotid string, active boolean, activesince bigint, address string,
        altitude int, channel int, demarcated boolean, description string,
        lat1 float, lat2 float, lat3 float, lat4 float,
        lng1 float, lng2 float, lng3 float, lng4 float,
        nodeid string, objectid string, occupancy boolean, orgid string,
        parkinggroupid string, parkingzoneid string, since bigint, siteid string,
        tags string,
        x1 float, x2 float, x3 float, x4 float, y1 float, y2 float, y3 float, y4 float""",
    "parking_zone_group": "parkingzoneid string, parkinggroupid string",
    "aggregation_parking_status": """
        siteid string, starttime bigint, parkingspotid string, occupancy boolean""",
    "device_sensor_samples": """
        nodeid string, sensor string, date string, time bigint, value double""",
    "device_energy_settings": """
        siteid string, nodeid string, legacy_power double, max_led_power double""",
    "device_alarms": """
        nodeid string, alarmtype string, alarmdate bigint, dateuuid string, message string,
        severitycode string""",
    "connection_status": "nodeid string, since bigint, isconnected boolean",
    "aggregation_connection_node": """
        nodeid string, starttime bigint, conduration bigint, conpercent double,
        disconnects int, enddt string, endtime bigint, startday string, startdt string,
        starthr string, ts bigint""",
    "aggregation_control": "type string, key string, val string",
    "aggregation_filters": "type string, obj string",
}

# Sentinels that stand for a missing value once a table has been read.
NULL_DEFAULTS: dict[str, dict[str, object]] = {
    "traffic_status": {
        "active": True, "channel": 0, "count": 0, "data": "na", "name": "na", "type": "na",
        "orgid": "na", "siteid": "na", "trafficdetectioneventid": "na", "updated": "na",
    },
    "traffic_current_status": {"count": 0, "aggregated_count": 0},
    "parking_spot_historic": {
        "parkingspotid": "na", "occupancy": False, "parkingzoneid": "na",
    },
    "parking_zone_status": {"config": "na"},
    "parking_spot_current": {"parkingzoneid": "na", "demarcated": False, "active": False},
    "device_sensor_samples": {"date": "na"},
}

# Sensor codes copied to the warehouse.
SENSOR_CODES = (
    "mPF", "jt", "aP", "ai", "rlya", "podme", "i", "P", "aPF", "WDT", "l-i", "bc", "bR",
    "pnd", "jtx", "mip", "vp", "aw", "PF", "lIR-i", "RF", "rf", "podm", "jtm", "bRA", "mt",
    "lt", "pc", "jty", "mw", "t", "aip", "lIR", "pdc", "mi", "pdt", "sn", "p", "jtz", "bRL",
    "T", "mP", "w", "v", "rlym", "l", "ppr",
)

# Sensors that report cumulative energy.
ENERGY_SENSORS = ("w", "mw")

# Alarm types copied to the warehouse.
ALARM_CODES = (
    "Assert", "Clear", "Disconnect", "HWFAIL_GPS", "HWFail_EEPROM", "HWFail_ISL29023",
    "HWFail_MMA8451", "HWFail_NIGHTHAWK", "HWFail_PodBus", "HWFail_RTC", "HWFail_SE95",
    "HWFail_STUCK_RELAY", "HWFail_ZMotion", "HardFault", "Minor", "PMACFail",
    "SWUpdateFail_SENSORPOD", "StrangeReboot", "X509ClientFail", "X509ServerFail",
    "CommFail", "SimFail", "USPFail", "PMACFail", "DriverFail", "FarmUSPFail",
    "HWFail_UrbanUSP", "SensorFail", "HWFail_generic", "HWFail_HIH6131", "HWFail_TSC3414",
    "SWUpdateFail_SensorPod", "HWFail_StuckRelay", "HWFail_SiHawk", "HWFail_GPS",
)


def schema_of(table: str) -> StructType:
    return StructType.fromDDL(_DDL[table])


def known_tables() -> tuple[str, ...]:
    return tuple(_DDL)
