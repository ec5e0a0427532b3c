"""regiocube.sources"""
