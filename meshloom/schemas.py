"""Record schemas. Every field is nullable; readers never infer."""

from __future__ import annotations

SUMMARY = "struct<num_vertices:bigint,num_faces:bigint,is_watertight:boolean,is_winding_consistent:boolean,euler_number:bigint,volume:double,area:double,bbox_extent:array<double>>"
STAGE_1 = "struct<resolution:bigint,dense_resolution:bigint,num_faces_in:bigint,num_faces_out:bigint,shell_voxels:bigint,thickened_voxels:bigint,interior_frac_raw:double,interior_frac_closed:double,open_shell_detected:boolean,ray_escape_frac:double,chamfer_to_input:double,is_watertight:boolean,is_winding_consistent:boolean,seconds_total:double,stage_timings:map<string,double>>"
STAGE_2 = "struct<mesh_sha256:string,aesthetic_quality:int,is_primitive:boolean,is_ground_plane:boolean,is_noisy_scan:boolean,is_fragmented:boolean,object_class:string,reasoning:string,accepted:boolean,rejection_reasons:array<string>,raw_response:string,model:string,prompt_lang:string,seconds:double>"
STAGE_3 = "struct<method:string,up_axis_world:array<double>,forward_axis_world:array<double>,rotation_matrix:array<array<double>>,vlm_up_label:string,vlm_front_label:string,vlm_agrees_with_geom:boolean,needs_manual_review:boolean,seconds:double,geom_inlier_fraction:double>"
VAE = "struct<chamfer:double,recon_vertices:bigint,recon_faces:bigint,time_encode:double,time_decode:double,time_query:double,time_mc:double,time_chamfer:double,error:string>"
#: The fields of VAE.
VAE_FIELDS = ("chamfer", "recon_vertices", "recon_faces", "time_encode", "time_decode", "time_query", "time_mc", "time_chamfer", "error")
METRICS = f"struct<num_components:bigint,is_watertight:boolean,is_winding_consistent:boolean,volume_area_ratio:double,ray_sign_agreement:double,ray_samples:bigint,fraction_inside_gt:double,fraction_inside_cubvh:double,vae:{VAE},num_vertices:bigint,num_faces:bigint,axis_aligned_area_fraction:double,ray_sign_error:string,vae_error:string,primitive_error:string>"
STAGE_4 = f"struct<is_valid:boolean,reasons:array<string>,metrics:{METRICS},seconds:double>"

#: One nested record per mesh, from the single-mesh pipeline.
RESULT = f"sha256 string, input_path string, output_path string, accepted boolean, rejection_reasons array<string>, stage_timings map<string,double>, stage_reports struct<stage1_watertighten:{STAGE_1},stage2_vlm_filter:{STAGE_2},stage3_canonicalize:{STAGE_3},stage4_filter_geometry:{STAGE_4}>, input_summary {SUMMARY}, output_summary {SUMMARY}, seconds_total double"
#: The flatter record of batch runs over datasets, errors included.
BATCH = f"dataset string, sha256 string, input_path string, accepted boolean, rejection_reasons array<string>, stage2_vlm {STAGE_2}, stage4_filter {STAGE_4}, seconds_total double, error string, error_msg string"
