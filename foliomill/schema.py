"""Schemas of nested page records, for reading and for literals in tests."""

from __future__ import annotations

from pyspark.sql.types import StructType

BBOX = "array<double>"
POLYGON = "array<array<double>>"
STYLE = "struct<font_family:string,font_path:string,font_size_px:int,align:string,line_spacing:double,bold:boolean,italic:boolean>"
LINE = f"struct<line_id:string,bbox:{BBOX},text:string,reading_order:int,polygon:{POLYGON}>"
CELL_METADATA = (
    f"struct<rendered_font_size:int,rendered_lines:array<string>,rendered_bbox:{BBOX},rendered_bbox_polygon:{POLYGON},rendered_inside_cell:boolean,"
    "rendered_text_y:int,rendered_line_height:int,value_type:string,mixing_feature:string,mixing_features:array<string>,wrap_state:boolean,rendered_complete:boolean>"
)
CELL = f"struct<row:int,col:int,bbox:{BBOX},text:string,language:string,reading_order:int,polygon:{POLYGON},metadata:{CELL_METADATA}>"
FIELD = (
    f"struct<field_key:string,kind:string,label_text:string,value_text:string,label_bbox:{BBOX},value_bbox:{BBOX},row_bbox:{BBOX},"
    f"label_bbox_polygon:{POLYGON},value_bbox_polygon:{POLYGON},rendered_complete:boolean,font_size:int,wrap_state:boolean>"
)
ZONE_METADATA = (
    f"struct<role:string,corpus_record_id:string,grammar_source:string,date_role:string,date_roles:map<string,string>,signature_role:string,source_bbox:{BBOX},rendered_bbox:{BBOX},min_render_font_px:int,"
    f"text_truncated:boolean,rendered_entry_count:int,rendered_fields:array<{FIELD}>,form_label_width:double,form_separator_polygon:{POLYGON},mixing_feature:string,mixing_features:array<string>>"
)
ZONE = f"struct<zone_id:string,zone_type:string,role:string,bbox:{BBOX},polygon:{POLYGON},text:string,language:string,reading_order:int,style:{STYLE},lines:array<{LINE}>,cells:array<{CELL}>,metadata:{ZONE_METADATA}>"
EFFECT = "struct<effect:string,effect_id:string,level:string,params:map<string,string>,warnings:array<string>>"
ISSUE = "struct<code:string,severity:string,message:string,zone_id:string>"
ARTIFACT = f"struct<type:string,color_rgb:array<int>,opacity:double,stroke_width:double,target_zone:string,polygon:{POLYGON},bbox:{BBOX}>"

PAGE = (
    "page_id string, layout_id string, layout_variant string, layout_density string, language_mix string, primary_language string, secondary_language string, "
    "language_mix_ratio map<string,double>, mixing_features array<string>, quality_profile string, orientation string, width int, height int, content_height_ratio double, "
    "shard_id string, image_path string, content_lineage_id string, content_record_ids array<string>, grammar_source string, qa_ok boolean, "
    f"qa_flags array<string>, qa_issues array<{ISSUE}>, effect_chain array<{EFFECT}>, geometry_tier string, forward array<array<double>>, inverse array<array<double>>, artifacts array<{ARTIFACT}>, zones array<{ZONE}>"
)


def page_schema() -> StructType:
    return StructType.fromDDL(PAGE)


def zone_schema() -> StructType:
    return StructType.fromDDL(ZONE.removeprefix("struct<").removesuffix(">"))
