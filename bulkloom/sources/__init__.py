"""Readers: wide variant tables, VCF text, effect tables, contigs, reads, stage logs."""
