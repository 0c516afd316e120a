"""Schemas of the model's tables; every reader and generator uses these."""

POINT = "struct<x:double,y:double>"
POP_CELL = "row int, col int, pop double"
DEM_CELL = "row int, col int, z double"
ROAD = f"source_id string, grade_key string, road_class string, oneway string, access string, pts array<{POINT}>"
SEGMENT = f"segment_id string, source_id string, grade_key string, road_class string, oneway string, seq int, a {POINT}, b {POINT}"
NODE = "node_id string, x double, y double"
EDGE = "edge_id string, source_id string, from_node string, to_node string, length_m double, final_road_class string, forward_allowed boolean, reverse_allowed boolean"
ARC = "arc_id string, edge_id string, from_node string, to_node string, distance_m double, time_min double, truck_energy_kwh double, cumulative_ascent_m double, cumulative_descent_m double"
SNAP = "terminal_id string, truck_anchor_id string, distance_covered boolean"
TERMINAL = "terminal_id string, truck_anchor_id string, truck_service_status string"
SERVICE = "terminal_id string, access_reference_x_m double, access_reference_y_m double"
PROFILE = "edge_id string, sample_distances_m array<double>, smoothed_elevations_m array<double>"
LINEAGE = "contracted_logical_arc_id string, contracted_logical_connection_id string, canonical_physical_edge_ids array<string>"
INPUT = "role string, path string, redistribution_permitted boolean"
CATALOGUE = "role string, website string, data_type string, download_url string, allowed_hosts array<string>"
