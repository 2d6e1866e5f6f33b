"""Column layouts of the engine's tables, and the constants stored in them."""

from __future__ import annotations

from pyspark.sql import types as T

# Bits of the flags columns.
FORWARD, REVERSE, BRIDGE, TUNNEL, CUTTING = 0x1, 0x2, 0x4, 0x8, 0x10
BUILDING, NAMEREF, STATE_CAPITAL, COUNTRY_CAPITAL, INNER = 0x20, 0x40, 0x100, 0x200, 0x1000

# Bits of a line's mode.
LINE_MODES = {"solid": 0, "dashed": 1, "striped": 2, "named": 4}
NAMED = 4

#: Zooms that are stored; an even zoom is served from the odd one above it.
ZOOMS = (15, 13, 11, 9, 7, 5, 3)

RELATION_TYPES = ("none", "boundary", "multipolygon")
MEMBER_TYPES = ("none", "node", "way", "relation")
MEMBER_ROLES = ("none", "outer", "inner", "admin_centre", "label")


def _struct(text: str) -> T.StructType:
    return T._parse_datatype_string(text)


TAG = "struct<k:string,v:string>"
RAW_NODE = f"id bigint, changeset bigint, lat double, lon double, tags array<{TAG}>"
RAW_WAY = f"id bigint, changeset bigint, nds array<bigint>, tags array<{TAG}>"
RAW_RELATION = f"id bigint, changeset bigint, members array<struct<type:string,ref:bigint,role:string>>, tags array<{TAG}>"

RANGE = "latT double, lonL double, latB double, lonR double"
TABLES = {
    "node_coord": "nid bigint, lat double, lon double",
    "node_info": "nid bigint, class int, flags int, ele int, name string",
    "way_info": "wid bigint, class int, flags int, layer int, name string",
    "way_range": f"wid bigint, {RANGE}",
    "way_nds": "wid bigint, nds array<bigint>",
    "rel_info": "rid bigint, nid bigint, class int, flags int, type int, name string",
    "rel_members": "rid bigint, members array<struct<wid:bigint,inner:int>>",
    "rel_range": f"rid bigint, {RANGE}",
    "tile_ref": "kind string, zoom int, x int, y int, ref bigint",
    "attr": "key string, val string",
}

POINT = "struct<x:smallint,y:smallint>"
BOX = "struct<t:smallint,l:smallint,b:smallint,r:smallint>"
WAY = f"struct<class:int,flags:int,layer:int,center:{POINT},range:{BOX},name:string,pts:array<{POINT}>>"
REL = f"struct<class:int,flags:int,type:int,center:{POINT},range:{BOX},name:string,ways:array<{WAY}>>"
NODE = f"struct<class:int,flags:int,ele:int,pt:{POINT},name:string>"
TILE = f"zoom int, x int, y int, changeset bigint, rels array<{REL}>, ways array<{WAY}>, nodes array<{NODE}>"
