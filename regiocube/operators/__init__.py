"""regiocube.operators"""
