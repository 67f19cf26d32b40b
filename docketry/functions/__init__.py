"""docketry.functions"""
