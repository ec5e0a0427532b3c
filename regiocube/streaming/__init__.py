"""regiocube.streaming"""
