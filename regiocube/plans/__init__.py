"""regiocube.plans"""
