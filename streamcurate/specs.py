"""Sensor specifications: schema, aliases, units and plausibility limits of each built-in sensor."""

from __future__ import annotations

from dataclasses import dataclass, field


@dataclass(frozen=True)
class Field:
    type: str
    required: bool = False
    nullable: bool = True


@dataclass(frozen=True)
class SensorSpec:
    """What the record operators need to know of a sensor.  Key of a registry: (name, version), exactly."""

    name: str
    fields: dict[str, Field]
    version: str = "1.0.0"
    allow_extra: bool = False
    aliases: dict[str, str] = field(default_factory=dict)
    dimensions: dict[str, tuple[str, ...]] = field(default_factory=dict)
    limits: dict[str, float | None] = field(default_factory=dict)
    magnitudes: dict[str, tuple[str, str, str]] = field(default_factory=dict)

    def of_type(self, *types: str) -> list[str]:
        return [n for n, f in self.fields.items() if f.type in types]


# Conversion factors to the canonical unit of each dimension.
UNITS = {
    "acceleration": {"m/s^2": 1.0, "g": 9.80665},
    "angular_velocity": {"rad/s": 1.0, "deg/s": 0.017453292519943295},
    "altitude": {"m": 1.0, "ft": 0.3048},
    "speed": {"m/s": 1.0, "km/h": 1000 / 3600, "mph": 0.44704},
    "force": {"N": 1.0, "kN": 1000.0, "lbf": 4.4482216152605},
    "torque": {"N*m": 1.0, "N·m": 1.0, "mN*m": 0.001, "mN·m": 0.001, "lbf*ft": 4.4482216152605 * 0.3048, "lbf·ft": 4.4482216152605 * 0.3048},
}

# Field names, accepted aliases and limits of the built-in sensors.
_need, _may = Field("float", True, False), Field("float")
_time, _device = Field("datetime", True, False), Field("string")
ACCEL, GYRO = ("accel_x", "accel_y", "accel_z"), ("gyro_x", "gyro_y", "gyro_z")
FORCE, TORQUE = ("force_x", "force_y", "force_z"), ("torque_x", "torque_y", "torque_z")

IMU = SensorSpec(
    "imu",
    {"timestamp": _time, **dict.fromkeys(ACCEL, _need), **dict.fromkeys(GYRO, _may), "device_id": _device},
    aliases={"Accel X": "accel_x", "Accel Y": "accel_y", "Accel Z": "accel_z", "acc_x": "accel_x", "acc_y": "accel_y", "acc_z": "accel_z", "ax": "accel_x", "ay": "accel_y", "az": "accel_z", "Gyro X": "gyro_x", "Gyro Y": "gyro_y", "Gyro Z": "gyro_z", "gx": "gyro_x", "gy": "gyro_y", "gz": "gyro_z"},
    dimensions={"acceleration": ACCEL, "angular_velocity": GYRO},
    limits={**dict.fromkeys(ACCEL, 200.0), **dict.fromkeys(GYRO, 50.0)},
    magnitudes={"accel_magnitude": ACCEL, "gyro_magnitude": GYRO},
)
GPS = SensorSpec(
    "gps",
    {"timestamp": _time, "latitude": _need, "longitude": _need, "altitude": _may, "speed": _may, "device_id": _device},
    aliases={"lat": "latitude", "lon": "longitude", "lng": "longitude", "alt": "altitude"},
    dimensions={"altitude": ("altitude",), "speed": ("speed",)},
)
FORCE_TORQUE = SensorSpec(
    "force_torque",
    {"timestamp": _time, **dict.fromkeys(FORCE + TORQUE, _need), "device_id": _device},
    aliases={"fx": "force_x", "fy": "force_y", "fz": "force_z", "tx": "torque_x", "ty": "torque_y", "tz": "torque_z"},
    dimensions={"force": FORCE, "torque": TORQUE},
    limits=dict.fromkeys(FORCE + TORQUE),
    magnitudes={"force_magnitude": FORCE, "torque_magnitude": TORQUE},
)


class SpecRegistry:
    """Specs by exact (name, version); a repeated key is an error, there is no latest."""

    def __init__(self, *specs: SensorSpec):
        self.by_key: dict[tuple[str, str], SensorSpec] = {}
        for spec in specs:
            self.add(spec)

    def add(self, spec: SensorSpec) -> None:
        if (spec.name, spec.version) in self.by_key:
            raise ValueError(f"{spec.name} {spec.version} is registered already")
        self.by_key[spec.name, spec.version] = spec

    def get(self, name: str, version: str) -> SensorSpec:
        return self.by_key[name, version]


BUILT_IN = SpecRegistry(IMU, GPS, FORCE_TORQUE)
